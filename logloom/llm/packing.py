"""Packing documents into fixed-size windows, online and in bounded space.

A task keeps ``open_windows`` windows. What a document has beyond whole windows
goes to the open window that it fills best; when none has room for it, the
fullest is filled up with a part, emitted, and the rest is placed again. What is
open at the end of a task is merged afterwards: the windows of ``merge_tasks``
tasks are strung together and cut anew, so each such group leaves at most one
padded window. A task holds its open windows and one batch of texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import slices, stage
from .tokens import TEXTS, encoder

PIECES = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()),
    ("sequence_id", pa.int64()), ("offset", pa.int64()), ("part", pa.int64()), ("open", pa.bool_()),
])


class Windows:
    """Open windows of one task; ``out`` collects the pieces of closed ones."""

    def __init__(self, capacity: int, count: int, part: int):
        self.capacity, self.count, self.part = capacity, count, part
        self.made, self.out = 0, []
        self.windows: list[list] = []  # [used, sequence_id, pieces]

    def new(self) -> list:
        self.made += 1
        return [0, (self.part << 32) + self.made - 1, []]

    def close(self, window: list, still_open: bool = False) -> None:
        self.out += [(*p, self.part, still_open) for p in window[2]]

    def put(self, window: list, doc_id, start: int, ids: bytes, total: int) -> None:
        window[2].append((doc_id, start, len(ids) // 4, ids, total, window[1], window[0]))
        window[0] += len(ids) // 4

    def add(self, doc_id, ids: bytes) -> None:
        total, at, room = len(ids) // 4, 0, self.capacity
        while total - at >= room:
            window = self.new()
            self.put(window, doc_id, at, ids[4 * at : 4 * (at + room)], total)
            self.close(window)
            at += room
        while at < total:
            need = total - at
            fits = [w for w in self.windows if self.capacity - w[0] >= need]
            if fits:
                window = max(fits, key=lambda w: w[0])
            elif len(self.windows) < self.count:
                window = self.new()
                self.windows.append(window)
            else:
                window = max(self.windows, key=lambda w: w[0])
            take = min(need, self.capacity - window[0])
            self.put(window, doc_id, at, ids[4 * at : 4 * (at + take)], total)
            at += take
            if window[0] == self.capacity:
                self.windows.remove(window)
                self.close(window)

    def flush(self, still_open: bool) -> pa.RecordBatch:
        if still_open:
            for window in self.windows:
                self.close(window, True)
        columns = list(zip(*self.out)) or [[] for _ in PIECES]
        self.out = []
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, PIECES)], schema=PIECES)


def _packed(path: str | None, end_id: int, capacity: int, count: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(path), np.array([end_id], "<u4").tobytes()
        windows = Windows(capacity, count, TaskContext.get().partitionId())
        for batch in batches:
            for part in slices(batch, TEXTS):
                for doc_id, ids in zip(part.column(0).to_pylist(), encode(part.column(1).to_pylist())):
                    windows.add(doc_id, ids + end)
                yield windows.flush(False)
        yield windows.flush(True)

    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, capacity: int = 1024, open_windows: int = 64,
         merge_tasks: int = 256, tokenizer: str | None = None, end_id: int = 0) -> DataFrame:
    """Pieces of documents in sequences of at most ``capacity`` tokens: one row
    (doc_id, start, length, ids, doc_tokens, sequence_id, offset) for each
    piece; ids are little-endian uint32 in binary. Every token of every row of
    docs, with end_id after each document, lies in exactly one piece, and a
    sequence's offsets run from 0 without gaps.

    Null and empty texts are the end id alone. Null and repeated ids are values
    like any other: each row is packed. An empty table gives no pieces. Other
    columns are not read, whatever their names.
    """
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    pieces = stage(texts.mapInArrow(
        _packed(tokenizer, end_id, capacity, open_windows),
        "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, part long, open boolean"))
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    # string the open windows of a group of tasks together and cut the string anew
    left = pieces.where("open").withColumn("grp", F.floor(F.col("part") / merge_tasks))
    before = Window.partitionBy("grp").orderBy("sequence_id").rowsBetween(Window.unboundedPreceding, -1)
    base = left.groupBy("grp", "sequence_id").agg(F.sum("length").alias("used")).select(
        "sequence_id", F.coalesce(F.sum("used").over(before), F.lit(0)).alias("base"))
    cap = F.lit(capacity)
    strung = left.join(base, "sequence_id").withColumn("at", F.col("base") + F.col("offset"))
    strung = strung.withColumn("window", F.explode(F.sequence(
        F.floor(F.col("at") / cap), F.floor((F.col("at") + F.col("length") - 1) / cap))))
    strung = strung.withColumn("lo", F.greatest(F.col("at"), F.col("window") * cap)).withColumn(
        "hi", F.least(F.col("at") + F.col("length"), (F.col("window") + 1) * cap))
    merged = strung.select(
        "doc_id", (F.col("start") + F.col("lo") - F.col("at")).alias("start"), (F.col("hi") - F.col("lo")).alias("length"),
        F.expr("substring(ids, cast(4 * (lo - at) + 1 as int), cast(4 * (hi - lo) as int))").alias("ids"), "doc_tokens",
        (F.lit(1 << 62) + F.col("grp") * F.lit(1 << 40) + F.col("window")).alias("sequence_id"),
        (F.col("lo") - F.col("window") * cap).alias("offset"),
    )
    return pieces.where("not open").select(names).union(merged)


def digest(pieces: DataFrame) -> DataFrame:
    """The pieces with ``ids_crc32`` in place of their ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
