"""Helpers shared by the training-data operators.

Words are runs of anything but ASCII white space (``[^\\x20\\x09-\\x0D]+``) and
only A-Z are lower-cased. On bytes these are exactly ``bytes.split()`` and
``bytes.lower()``, so Python tasks work on the UTF-8 bytes of whole texts.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What separates words, as a Java and DuckDB pattern.
SPACE = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """The words of a text as an array; null text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n: the folds of the trained operators."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(n))


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for written intermediate tables: the session's
    ``spark.checkpoint.dir``. Only a local session without one gets a
    temporary folder; a cluster must name a shared one."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if found:
        return found
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = "file://" + tempfile.mkdtemp(prefix="llm-checkpoint-")
    spark.sparkContext.setCheckpointDir(path)
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def stage(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Write df as Parquet under the shared folder and read it back: cuts the
    lineage, survives lost executors, and is removed when the session ends.
    Without a compression the session's is used."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    remove_at_end(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def remove_at_end(spark: SparkSession, path: str) -> None:
    """Have a written folder deleted when the session ends."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jvm_path)


def map_rows(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch | None]], schema: str,
             max_bytes: int = 16 << 20) -> DataFrame:
    """``mapInArrow`` with bounded slices: make() runs once a task and returns
    a function from a record batch of at most about max_bytes (one row may
    exceed it) to a record batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            for part in slices(batch, max_bytes):
                out = step(part)
                if out is not None and out.num_rows:
                    yield out

    return df.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, max_bytes: int) -> Iterator[pa.RecordBatch]:
    if batch.num_rows == 0:
        return
    rows = max(1, int(batch.num_rows * max_bytes / max(1, batch.nbytes)))
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def record(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.record_batch([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


# ------------------------------------------------------------------ hashing

_U = np.uint64
GOLD = _U(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser on uint64 arrays."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


# ------------------------------------------------------- connected components


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Components of an undirected graph given as (a, b) long pairs: returns
    (node, component), the component being its smallest node. Nodes are those
    that occur in an edge; self-loops and repeated or null pairs are ignored.

    Alternates the large-star and small-star steps: every step is a min over
    each node's neighbours (pre-aggregated before the shuffle) joined back to
    the edges, so a hub never meets its neighbours in one group; each round is
    written to the shared folder. Stops when the edges are a forest of stars.
    """
    now = stage(
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    for _ in range(max_rounds):
        # large star: every larger neighbour of u hangs on the smallest of u's neighbourhood
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: u's smaller neighbours, and u, hang on the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))
        )).alias("e")).select("e.u", "e.v").where("u != v").distinct()
        now = stage(small)
        # a forest of stars: each child once, and no root is a child
        links, children = now.agg(F.count("*"), F.count_distinct("u")).first()
        if links == children and now.join(now.select(F.col("v").alias("u")).distinct(), "u", "left_semi").isEmpty():
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select("v", "v").distinct()
    )


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the links (a, b), those that a union-find pass needs: one spanning
    forest of the same components."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (p := parent.setdefault(x, x)) != x:
            parent[x] = parent[p]
            x = p
        return x

    keep = []
    for i, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        x, y = root(x), root(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
            keep.append(i)
    return a[keep], b[keep]
