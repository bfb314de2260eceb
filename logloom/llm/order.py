"""Training-order materialisation: token sequences at keyed random places.

Every document's ids are cut into sequences. A sequence's number (dense, from 0)
goes through a keyed Feistel permutation over the next even power of two, walked
until it falls below the number of sequences: that is its global slot, a
shuffle of the whole corpus that needs no sort key to be stored. Range
partitions of slots are written as shards of equal numbers of rows, all of the
same stride, so a reader finds slot s at row s % rows of shard s // rows and
resumes anywhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import GOLD, map_rows, mix64, slices, stage
from .tokens import TEXTS, encoder

_U = np.uint64
#: Runs whose numbers are broadcast; with more of them the join shuffles.
BROADCAST_RUNS = 1 << 20


def feistel(index: np.ndarray, n: int, key: int, rounds: int = 6) -> np.ndarray:
    """The slots of the numbers index in a keyed permutation of 0..n-1."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask = _U((1 << half) - 1)
    with np.errstate(over="ignore"):
        keys = mix64(_U(key) + np.arange(1, rounds + 1, dtype=_U) * GOLD)
    out = index.astype(_U)
    walk = np.arange(len(out))
    while len(walk):
        left, right = out[walk] >> _U(half), out[walk] & mask
        for k in keys:
            left, right = right, left ^ (mix64(right ^ k) & mask)
        out[walk] = (left << _U(half)) | right
        walk = walk[out[walk] >= _U(n)]
    return out.astype(np.int64)


SEQUENCES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                       ("file", pa.int64()), ("run", pa.int64()), ("number", pa.int64())])


def _cut(path: str | None, end_id: int, length: int):
    """Sequences numbered within their run: the documents of one file that a
    task reads one after the other, named by its first row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task, rows = encoder(path), TaskContext.get().partitionId(), 0
        now, first, last, number = None, 0, -2, 0
        for batch in batches:
            for some in slices(batch, TEXTS):
                out = []
                for doc_id, found, file, row in zip(some.column(0).to_pylist(), encode(some.column(1).to_pylist()), *(c.to_pylist() for c in some.columns[2:])):
                    if file is None:
                        file, row = task, rows
                    rows += 1
                    if file != now or row != last + 1:
                        now, first, number = file, row, 0
                    last = row
                    ids = np.append(np.frombuffer(found, "<u4"), end_id)
                    if ids.max() > 0xFFFF:
                        raise ValueError("the tokenizer's ids do not fit 16 bits")
                    for start in range(0, len(ids), length):
                        piece = ids[start : start + length]
                        out.append((doc_id, start, len(piece), piece.astype("<u2").tobytes(), file, first, number))
                        number += 1
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), SEQUENCES)], schema=SEQUENCES)

    return run


def materialise(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", *, length: int = 1024, key: int = 2024,
                shard_rows: int = 4096, tokenizer: str | None = None, end_id: int = 0, place: tuple[Column, Column] | None = None) -> None:
    """Write docs in training order under path: Parquet shards of shard_rows
    rows (shard, slot, doc_id, start, length, ids), ids padded with 0 to length
    little-endian uint16 numbers; sorted by slot. The tokenizer's ids must be below
    65,536 (larger ones are an error).

    place gives each row its file (long) and its row in that file, as
    ``stored_place`` does: sequences are then numbered in the order of the
    stored rows, so the same files and key give the same slots however the
    files are split over tasks. Without it the order is that of the tasks, and
    the same slots need the same splits.

    end_id follows each document. Null and empty texts are that id alone; null
    and repeated ids are values like any other. An empty table writes no rows.
    Other columns are not read.
    """
    file, row = place or (F.lit(None), F.lit(None))
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"),
                        file.cast("long").alias("file"), row.cast("long").alias("row"))
    cut = stage(texts.mapInArrow(_cut(tokenizer, end_id, length),
                                 "doc_id long, start long, length long, ids binary, file long, run long, number long"), "zstd")
    # one row of three numbers for each split that was read: 24 MB for a million splits
    runs = cut.groupBy("file", "run").agg(F.count("*").alias("rows"))
    before = Window.orderBy("file", "run").rowsBetween(Window.unboundedPreceding, -1)
    bases = runs.select("file", "run", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("base"))
    n = cut.count()
    if bases.count() <= BROADCAST_RUNS:
        bases = F.broadcast(bases)
    numbered = cut.join(bases, ["file", "run"]).select("doc_id", "start", "length", "ids", (F.col("base") + F.col("number")).alias("slot"))

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            slot = feistel(batch.column(4).to_numpy(), n, key)
            return pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(slot)], names=batch.schema.names)

        return step

    placed = map_rows(numbered, make, "doc_id long, start long, length long, ids binary, slot long")
    shards = max(1, -(-n // shard_rows))
    parts = min(shards, 20_000)
    stride = F.rpad("ids", 2 * length, F.lit(b"\x00"))
    # slots are dense, so the bounds of equal ranges are known without a sample
    placed.withColumn("shard", F.floor(F.col("slot") / shard_rows)).repartitionById(
        parts, F.floor(F.col("shard") * parts / shards).cast("int")).sortWithinPartitions(
        "slot").select("shard", "slot", "doc_id", "start", "length", stride.alias("ids")).write.partitionBy("shard").option(
        "compression", "zstd").parquet(path)


def stored_place() -> tuple[Column, Column]:
    """place for docs read straight from Parquet files: a hash of the file's path, and the row in it."""
    return F.xxhash64("_metadata.file_path"), F.col("_metadata.row_index")


def read(spark: SparkSession, path: str, from_slot: int = 0, shard_rows: int = 4096) -> DataFrame:
    """The sequences from a slot on: earlier shards are not opened."""
    types = "slot long, doc_id long, start long, length long, ids binary, shard long"
    return spark.read.schema(types).parquet(path).where((F.col("shard") >= from_slot // shard_rows) & (F.col("slot") >= from_slot))
