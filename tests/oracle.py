"""Run ``queries()`` in Spark and ``oracle_sql()`` in DuckDB on the same
tables and compare them: columns by name, rows as an order-free multiset."""

from __future__ import annotations

import re

import datetime
import decimal
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, decimal.Decimal):
        return int(v) if v == v.to_integral_value() else float(v)
    if isinstance(v, datetime.datetime):
        return v.isoformat(sep=" ")
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    out = sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)
    return names, out


def compare(spark, sf_dir: str, name: str, query, sql: str, con=None) -> dict:
    con = con or duck(sf_dir)
    sdf = query(spark, sf_dir)
    s_names, s_rows = rows_of(sdf.columns, [tuple(r) for r in sdf.collect()])
    rel = con.sql(sql)
    d_names, d_rows = rows_of(rel.columns, rel.fetchall())
    return {
        "name": name,
        "spark_rows": len(s_rows),
        "oracle_rows": len(d_rows),
        "columns_match": s_names == d_names,
        "values_match": s_rows == d_rows,
        "spark_columns": s_names,
        "oracle_columns": d_names,
    }


def own(names) -> list[str]:
    """The names of the library's own queries, without the training-data ones,
    some of which SQL cannot express; those are held against brute force in
    their own tests."""
    return sorted(n for n in names if not re.match(r"op\d+_|pipeline$", n))
