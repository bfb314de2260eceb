"""Quote-exact scan of CSV text in splits.

A quoted field may hold line ends, so where a record starts depends on all
quotes before it in its file. Yet a line only maps two states, outside or
inside a quoted field, to two; such maps compose, so a split's whole effect is
two flags. One pass over the splits of the files that hold a quote gives the
flags, a running composition along each file gives the state in which every
split starts, and the splits are then cut into records independently. What a
record leaves in several splits (head, middle, tail) is put together by the
record it belongs to. Files stay splittable, whatever they quote.

Records are read as Python's ``csv`` module reads them: a quote opens a field
only at its start, text after the closing quote belongs to the field, and a
quote that is never closed takes the rest of the file.
"""

from __future__ import annotations

import csv
import io
import re
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: From inside a quoted field to that field's end; a whole quoted field. A
#: carriage return ends a record as a newline does.
_REST = re.compile(r'(?:[^"]++|"")*+"[^,\r]*+')
_QUOTED = re.compile(r'"(?:[^"]++|"")*+"[^,\r]*+')
_SEPARATOR = re.compile(r"[,\r]")
_INNER_RETURN = re.compile(r"\r(?!\Z)")

PLAIN, PARSED, HEAD, TAIL = 0, 1, 2, 3


def left_open(line: str, inside: bool) -> bool:
    """Whether a quoted field is open at the end of a line that starts inside one, or not."""
    at = 0
    if inside:
        if (m := _REST.match(line)) is None:
            return True
        at = m.end() + 1
        if m.end() >= len(line):
            return False
    while True:
        if line.startswith('"', at):
            if (m := _QUOTED.match(line, at)) is None:
                return True
            end = m.end()
        elif (m := _SEPARATOR.search(line, at)) is None:
            return False
        else:
            end = m.start()
        if end >= len(line):
            return False
        at = end + 1


def records(text: str) -> list[list[str]]:
    """The records of whole lines, as ``csv.reader`` reads them."""
    csv.field_size_limit(sys.maxsize)
    return list(csv.reader(io.StringIO(text + "\n", newline="")))


def text_lines(spark: SparkSession, path: str, glob: str | None, prune: Column | None, day: Column) -> DataFrame:
    """Physical lines (value) with file, block (the start of their split) and day."""
    reader = spark.read.option("lineSep", "\n")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    raw = reader.text(path)
    if prune is not None:
        raw = raw.filter(prune)
    return raw.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), day.alias("file_date"))


def files_with_quotes(lines: DataFrame) -> list[str]:
    """The files that hold a quote: names only, as a listing gives them."""
    return sorted(r.file for r in lines.where(F.contains("value", F.lit('"'))).select("file").distinct().collect())


_EFFECT = pa.schema([("file", pa.string()), ("block", pa.int64()), ("from_outside", pa.bool_()), ("from_inside", pa.bool_())])


def _effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the lines of each split, null where they hold no quote: whether a field is
    open at the split's end if none was, or one was, at its start."""
    key, outside, inside, out = None, False, True, []
    for batch in batches:
        for file, block, line in zip(*(c.to_pylist() for c in batch.columns)):
            if key != (file, block):
                if key is not None:
                    out.append((*key, outside, inside))
                key, outside, inside = (file, block), False, True
            if line is not None:
                outside, inside = left_open(line, outside), left_open(line, inside)
    if key is not None:
        out.append((*key, outside, inside))
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), _EFFECT)], schema=_EFFECT)


def split_states(lines: DataFrame) -> DataFrame:
    """(file, block, inside, crossed): whether each split starts inside a quoted
    field, and whether a record goes on from or past it."""
    told = lines.select("file", "block", F.when(F.contains("value", F.lit('"')), F.col("value")).alias("value"))
    effects = told.mapInArrow(_effects, "file string, block long, from_outside boolean, from_inside boolean")
    along = Window.partitionBy("file").orderBy("block")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    fixed = F.col("from_outside") == F.col("from_inside")
    flips = (~fixed & F.col("from_outside")).cast("int")
    # the last split whose end does not depend on its start, and how often the state turned since
    counted = effects.withColumn("turned", F.sum(flips).over(along.rowsBetween(Window.unboundedPreceding, 0)))
    last = F.last(F.when(fixed, F.struct(F.col("from_outside").alias("state"), F.col("turned"))), ignorenulls=True).over(before)
    counted = counted.withColumn("last", last).withColumn("so_far", F.coalesce(F.sum(flips).over(before), F.lit(0)))
    odd = (F.col("so_far") - F.coalesce("last.turned", F.lit(0))) % 2 == 1
    known = counted.withColumn("inside", F.coalesce("last.state", F.lit(False)) != odd)
    ends = F.when(F.col("inside"), F.col("from_inside")).otherwise(F.col("from_outside"))
    return known.select("file", "block", "inside", (F.col("inside") | ends).alias("crossed"))


_CUT = pa.schema([("file", pa.string()), ("file_date", pa.date32()), ("block", pa.int64()), ("kind", pa.int32()), ("value", pa.string()), ("fields", pa.list_(pa.string()))])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of splits, in order, to records: PLAIN lines without a quote as they
    are, PARSED ones as fields, and what crosses a split's start or end as text."""
    key, day, held, in_head = None, None, [], False
    out: list[tuple] = []

    def flush() -> pa.RecordBatch:
        made = pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), _CUT)], schema=_CUT)
        out.clear()
        return made

    def leave() -> None:
        if held:
            out.append((key[0], day, key[1], HEAD if in_head else TAIL, "\n".join(held), None))

    def whole(text: str) -> None:
        out.extend((key[0], day, key[1], PARSED, None, row) for row in records(text))

    for batch in batches:
        for file, block, date, inside, line in zip(*(c.to_pylist() for c in batch.columns)):
            if key != (file, block):
                leave()
                key, day, held, in_head = (file, block), date, [], inside
            if in_head or held:
                held.append(line)
                if '"' in line and not left_open(line, True):
                    if in_head:
                        leave()
                    else:
                        whole("\n".join(held))
                    held, in_head = [], False
            elif '"' in line:
                if left_open(line, False):
                    held.append(line)
                else:
                    whole(line)
            elif _INNER_RETURN.search(line):
                whole(line)
            else:
                out.append((file, date, block, PLAIN, line, None))
            if len(out) >= 8192:
                yield flush()
    leave()
    if out:
        yield flush()


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(day, row) for day, text in zip(*(c.to_pylist() for c in batch.columns)) for row in records(text)]
        if rows:
            yield pa.record_batch([pa.array([d for d, _ in rows], pa.date32()), pa.array([r for _, r in rows], pa.list_(pa.string()))], names=["file_date", "fields"])


def quoted_records(lines: DataFrame) -> DataFrame:
    """(file_date, fields array<string>) of the records of ``text_lines``.

    The states, one row a split as the driver's own list of splits, are broadcast;
    lines stay where they are read. Only the pieces of records that cross splits
    are shuffled, and a record meets only its own pieces.
    """
    states = F.broadcast(split_states(lines))
    cut_type = "file string, file_date date, block long, kind int, value string, fields array<string>"

    def cut(of: DataFrame) -> DataFrame:
        return of.select("file", "block", "file_date", "inside", "value").mapInArrow(_cut, cut_type)

    known = lines.join(states, ["file", "block"])
    rows = cut(known).where(F.col("kind") <= PARSED)
    plain = F.split(F.regexp_replace("value", r"\r$", ""), ",", -1)
    rows = rows.select("file_date", F.when(F.col("kind") == PLAIN, plain).otherwise(F.col("fields")).alias("fields"))
    pieces = cut(known.where("crossed")).where(F.col("kind") >= HEAD)
    # a split's head belongs to the last tail before it
    order = Window.partitionBy("file").orderBy("block", "kind")
    owned = pieces.withColumn("record", F.sum((F.col("kind") == TAIL).cast("int")).over(order))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "kind", "value"))), lambda x: x["value"]), "\n")
    joined = owned.groupBy("file", "record").agg(F.first("file_date").alias("file_date"), text.alias("value"))
    return rows.unionByName(joined.select("file_date", "value").mapInArrow(_parse, "file_date date, fields array<string>"))
