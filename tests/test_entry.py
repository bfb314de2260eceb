"""The driver contract: entry() smoke run, and every registered query equal
to its DuckDB oracle at sf0.01."""

import pytest
from conftest import SF01
from oracle import compare, duck, own

import __spark_entry__ as entry

QUERIES = entry.queries()
ORACLE = entry.oracle_sql()


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["timestamp", "user", *[f"metric_{i}" for i in range(1, 10)]]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(ORACLE) <= set(QUERIES)
    assert own(QUERIES) == own(ORACLE)


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, SF01, name, QUERIES[name], ORACLE[name], con)
    assert r["columns_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["values_match"], r


@pytest.mark.parametrize("conf", [{"spark.sql.ansi.enabled": "false"}, {"spark.sql.session.timeZone": "Asia/Kolkata"}])
def test_queries_match_oracle_under_other_session_settings(spark, con, conf):
    # Sums without ANSI (try_sum and its overflow check), and a zone 30
    # minutes off the hour: every answer stays the same.
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        bad = [name for name in own(QUERIES)
               if not (r := compare(spark, SF01, name, QUERIES[name], ORACLE[name], con))["values_match"]
               or not r["columns_match"]]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert bad == []
