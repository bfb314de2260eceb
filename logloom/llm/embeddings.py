"""Near-duplicate embeddings by random-hyperplane sign hashing.

Equal vectors of a label are one class. Each of ``tables`` hash tables signs a
class's vector against ``bits`` random hyperplanes; classes of one label with
equal signs share a bucket. Buckets are compared in blocks of bounded size by
matrix products in double precision, and a pair that several tables bring
together counts in the first of them only. What leaves a block is a spanning
forest of its links and a count for each vector, never its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, forest, map_rows, record, stage


def _keys(tables: int, bits: int, seed: int):
    schema = pa.schema([("rep", pa.int64()), ("n", pa.int64()), ("label", pa.string()), ("vector", pa.binary()), ("keys", pa.binary())])
    planes: dict[int, np.ndarray] = {}

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            keys = []
            for v in batch.column(3).to_pylist():
                x = np.frombuffer(v, "<f8")
                if len(x) not in planes:
                    planes[len(x)] = np.random.default_rng([seed, len(x)]).standard_normal((tables * bits, len(x)))
                signs = (planes[len(x)] @ x > 0).reshape(tables, bits)
                keys.append((signs @ (1 << np.arange(bits))).astype("<u4").tobytes())
            return record(schema, *batch.columns, pa.array(keys, pa.binary()))

        return step

    return make


def _vectors():
    """Rows with the unit vector in float64, or null where it links with nothing."""
    schema = pa.schema([("vec_id", pa.int64()), ("label", pa.string()), ("vector", pa.binary())])

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for v in batch.column(2).to_pylist():
            ok = v and None not in v
            x = np.array(v, float) if ok else np.zeros(0)
            top = np.abs(x).max(initial=0)
            if not ok or not np.isfinite(top) or top == 0:
                out.append(None)
                continue
            x = x / top
            out.append((x / np.sqrt(x @ x)).astype("<f8").tobytes())
        return record(schema, batch.column(0), batch.column(1), pa.array(out, pa.binary()))

    return step


OUT = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("count", pa.int64())])


def _solve(rows: list[tuple], least: float) -> pa.RecordBatch | None:
    """rows: (side, table, rep, n, vector, keys). Links of one block: side 0
    against side 1, or all pairs of side 2."""
    table, one = rows[0][1], rows[0][0] == 2
    left = [r for r in rows if r[0] != 1]
    right = left if one else [r for r in rows if r[0] == 1]
    if not left or not right or (one and len(left) < 2):
        return None
    unpack = lambda side: (np.array([r[2] for r in side]), np.array([r[3] for r in side]), [np.frombuffer(r[4], "<f8") for r in side], np.array([np.frombuffer(r[5], "<u4") for r in side]))
    lid, ln, lv, lk = unpack(left)
    rid, rn, rv, rk = (lid, ln, lv, lk) if one else unpack(right)
    if len({len(v) for v in lv + rv}) != 1:  # vectors of different lengths never meet: the bucket holds the length
        return None
    cosine = np.array(lv) @ np.array(rv).T
    i, j = np.nonzero(np.triu(cosine >= least, 1) if one else cosine >= least)
    first = np.ones(len(i), bool)
    for lo in range(0, len(i), 65536):  # no earlier table brings the two together
        s = slice(lo, lo + 65536)
        first[s] = ~(lk[i[s], :table] == rk[j[s], :table]).any(axis=1)
    i, j = i[first], j[first]
    if not len(i):
        return None
    counts: dict[int, int] = {}
    for ids, other in ((lid[i], rn[j]), (rid[j], ln[i])):
        seen, at = np.unique(ids, return_inverse=True)
        for x, c in zip(seen.tolist(), np.bincount(at, other).tolist()):
            counts[x] = counts.get(x, 0) + int(c)
    a, b = forest(lid[i], rid[j])
    nodes = np.array(list(counts), np.int64)
    return record(OUT, pa.array(np.r_[a, nodes]), pa.array([*b.tolist(), *[None] * len(nodes)], pa.int64()),
                  pa.array([None] * len(a) + list(counts.values()), pa.int64()))


def _blocks(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []
        for batch in batches:
            for block, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if block != key:
                    if rows and (out := _solve(rows, least)) is not None:
                        yield out
                    key, rows = block, []
                rows.append(tuple(row))
        if rows and (out := _solve(rows, least)) is not None:
            yield out

    return run


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", *,
                    least: float = 0.93, tables: int = 24, bits: int = 11, block_rows: int = 512, seed: int = 1) -> DataFrame:
    """Groups of near-duplicate vectors: one row (vec_id, n_links, component_id,
    kept) for each row. Vectors of equal, non-null labels are linked when their
    cosine in double precision is least or more; n_links counts the linked other
    rows, component_id is the smallest id reachable.

    A pair escapes all tables with a chance of (1 - (1 - angle / pi)^bits)^tables:
    0.2 % at a cosine of 0.93, 4e-4 at 0.95, 3e-8 at 0.99. Found pairs are exact.

    Null, empty or zero vectors, vectors with null or non-finite components and
    null labels link with nothing. Vectors of different lengths are not linked.
    Null ids: the row stays, without links, component_id null, kept true. Rows
    that repeat an id are links of each other when they are linked as vectors.
    Other columns are not read.
    """
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{label_col}`").cast("string").alias("label"),
                          F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    units = map_rows(rows, _vectors, "vec_id long, label string, vector binary")
    base = stage(units.withColumn("class", F.when(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull(),
                                                  F.sha2(F.concat("label", F.lit("\x00"), F.hex("vector")), 256))))
    classes = base.where("class is not null").groupBy("class").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.first("label").alias("label"), F.first("vector").alias("vector"))
    keyed = stage(map_rows(classes.select("rep", "n", "label", "vector"), _keys(tables, bits, seed),
                           "rep long, n long, label string, vector binary, keys binary"))
    # buckets by their ids alone; only those with company carry vectors
    slot = F.explode(F.sequence(F.lit(0), F.lit(tables - 1)))
    slots = keyed.select("rep", "label", F.length("vector").alias("size"), "keys", slot.alias("t")).select(
        "rep", "t", F.xxhash64("label", "size", "t", F.substring("keys", F.col("t") * 4 + 1, F.lit(4))).alias("bucket"))
    shared = slots.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1")
    met = slots.join(shared, "bucket").withColumn("parts", F.ceil(F.col("members") / block_rows).cast("int")).withColumn(
        "p", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
    met = met.withColumn("q", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    blocks = met.select(
        F.xxhash64("bucket", F.least("p", "q"), F.greatest("p", "q")).alias("block"), F.expr("CASE WHEN p = q THEN 2 WHEN p > q THEN 1 ELSE 0 END").alias("side"), "t", "rep")
    whole = blocks.join(keyed.select("rep", "n", "vector", "keys"), "rep").select("block", "side", "t", "rep", "n", "vector", "keys")
    found = stage(whole.repartition("block").sortWithinPartitions("block").mapInArrow(_blocks(least), "a long, b long, count long"))
    counts = found.where("count is not null").groupBy(F.col("a").alias("rep")).agg(F.sum("count").alias("others"))
    components = connected_components(found.where("b is not null").select("a", "b"))
    about = classes.select("class", "rep", "n").join(counts, "rep", "left").join(
        components.withColumnRenamed("node", "rep"), "rep", "left").select(
        "class", (F.coalesce("others", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    return base.join(about, "class", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
