"""CSV writers (K1–K6).

Spark writes a directory of part files per output, range-partitioned by its
sort key: the parts in name order are the sorted whole, and no single task
holds it. Adaptive execution makes one part of a small result.
"""

from __future__ import annotations

import os
import uuid

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.time import timestamp_text
from ..operators.usage import UNIQUE_USERS, count_users, join_pairs, user_keys
from ..plans.args import METRICS
from ..sources.listing import create_exclusive, delete, exists, list_dir, rename

# The header line of each summary file, quotes included, as the
# exercise echoes it before appending the unquoted rows.
SUMMARY_HEADERS = {
    "apps_users.csv": ('"application"', '"number of unique users"'),
    "devices_users.csv": ('"device"', '"number of unique users"'),
    "apps_devices.csv": ('"application"', '"device"'),
}
_ORDER = "_line_order"
_CLAIM = "_claim-"


# Python csv.writer's default dialect: comma, double quote
# (doubled inside a quoted field), CRLF after each row; a field is quoted
# when it holds the delimiter, the quote or a line-break character.
_CSV_SPECIAL_RX = '[,"\r\n]'
_CSV_LINE_END = "\r\n"


def csv_field(value: Column) -> Column:
    """One field as ``csv.writer`` writes it (null as nothing)."""
    text = F.coalesce(value.cast("string"), F.lit(""))
    quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(text.rlike(_CSV_SPECIAL_RX), quoted).otherwise(text)


def csv_line(*values: Column) -> Column:
    r"""A row as ``csv.writer`` writes it, without its line end.

    Lines are built here and written with the ``text`` source: Spark's CSV
    writer would turn a newline inside a quoted value into the line
    separator (``\n`` into ``\r\n``), while ``csv.writer`` keeps it.
    """
    return F.concat_ws(",", *[csv_field(v) for v in values])


def _text_writer(df: DataFrame):
    return df.write.option("lineSep", _CSV_LINE_END)


def _csv_writer(df: DataFrame):
    """Spark's CSV writer in ``csv.writer``'s dialect: minimal quoting,
    doubled quotes, CRLF, no trimming, empty text written as nothing. It
    differs only in writing a newline inside a quoted value as CRLF."""
    return (
        df.write.option("header", False)
        .option("lineSep", _CSV_LINE_END)
        .option("quote", '"')
        .option("escape", '"')
        .option("emptyValue", "")
        .option("nullValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )


def _shell_writer(df: DataFrame):
    """Text as ``echo``, ``awk`` and ``join`` write it: fields joined by
    commas, nothing quoted or escaped, LF line ends. (The quote character is
    NUL, which no field holds; keys are cut at commas, so no field holds the
    delimiter either.)"""
    return (
        df.write.option("header", False)
        .option("lineSep", "\n")
        .option("quote", "\u0000")
        .option("emptyValue", "")
        .option("nullValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )


def _with_header_row(df: DataFrame, header: tuple[str, ...]) -> DataFrame:
    """``df`` as text behind one header row; ``_ORDER`` sorts the header first."""
    head = df.sparkSession.range(1).select(
        F.lit(0).alias(_ORDER), *[F.lit(h).alias(c) for h, c in zip(header, df.columns)]
    )
    body = df.select(F.lit(1).alias(_ORDER), *[F.col(c).cast("string").alias(c) for c in df.columns])
    return head.unionByName(body)


def free_name(taken: set[str], wanted: str) -> str:
    """``wanted`` unless taken; else its first part, ``_``, one more than the
    largest number so used among the taken names, and its extension (``.csv``
    when it has none)."""
    if wanted not in taken:
        return wanted
    head, tail = os.path.splitext(wanted)
    head, tail = head + "_", tail or ".csv"
    middles = (n.removeprefix(head).removesuffix(tail) for n in taken if n.startswith(head) and n.endswith(tail))
    return f"{head}{1 + max((int(m) for m in middles if m.isdecimal()), default=0)}{tail}"


def next_result_name(spark, directory: str, base_name: str = "result.csv") -> str:
    """The free name for a new result in a directory."""
    return free_name({entry.name for entry in list_dir(spark, directory)}, base_name)


def claim_result(spark, directory: str, base_name: str = "result.csv") -> tuple[str, str]:
    """The path of a free name and of the file that claims it for one writer.

    A claim is a file made only if none is there, and claimed names count as
    taken, so two writers at once take two names. A name that another writer
    finished between the listing and the claim is given up again. A writer that
    dies leaves its claim, and its name is passed over from then on.
    """
    while True:
        names = {entry.name for entry in list_dir(spark, directory)}
        free = free_name(names | {n.removeprefix(_CLAIM) for n in names if n.startswith(_CLAIM)}, base_name)
        claim, target = os.path.join(directory, _CLAIM + free), os.path.join(directory, free)
        if create_exclusive(spark, claim):
            if not exists(spark, target):
                return target, claim
            delete(spark, claim)


def write_result(result: DataFrame, directory: str, name: str = "result.csv") -> str | None:
    """Write an ``aggregate_logs`` result sorted by its key under the next
    free name, with its header, in ``csv.writer``'s dialect; return the path,
    or None (and leave no file) when empty.

    The result is computed once: it is written under a staging name while its
    rows are observed, then renamed, or deleted when there were none.
    """
    spark = result.sparkSession
    keys = [c for c in ("timestamp", "user", "app") if c in result.columns]
    seen = Observation()
    # Only text can need quoting; the integer sums are written as they are.
    fields = [
        csv_field(F.col(f.name)) if isinstance(f.dataType, StringType) else F.col(f.name).cast("string")
        for f in result.schema.fields
    ]
    body = result.observe(seen, F.count(F.lit(1)).alias("n")).select(
        F.lit(1).alias(_ORDER), *keys, F.concat_ws(",", *fields).alias("value"))
    head = spark.range(1).select(
        F.lit(0).alias(_ORDER),
        *[F.lit(None).cast("string").alias(k) for k in keys],
        csv_line(*[F.lit(c) for c in result.columns]).alias("value"),
    )
    staging = os.path.join(directory, f"_writing-{uuid.uuid4().hex}")
    _text_writer(head.unionByName(body).orderBy(_ORDER, *keys).select("value")).text(staging)
    if not seen.get.get("n", 0):
        delete(spark, staging)
        return None
    target, claim = claim_result(spark, directory, name)
    try:
        rename(spark, staging, target)
    finally:
        delete(spark, claim)
    return target


def write_summaries(user_app: DataFrame, user_device: DataFrame, directory: str, day=None) -> dict[str, str]:
    """The three summaries of one day, overwritten each run, each with its
    header even when empty: ``apps_users.csv`` (application, number of unique
    users), ``devices_users.csv`` (device, …), ``apps_devices.csv``
    (application, device). Written as the shell writes them: a quoted header
    line, then unquoted rows sorted by key, LF line ends.

    Each side is scanned and deduped to (user, key) once and persisted; the
    two counts and the pair join all read the deduped sides.
    """
    apps = user_keys(user_app, "application", day).persist(StorageLevel.MEMORY_AND_DISK)
    devices = user_keys(user_device, "device", day).persist(StorageLevel.MEMORY_AND_DISK)
    outputs = {
        "apps_users.csv": (count_users(apps, "application"), ["application"]),
        "devices_users.csv": (count_users(devices, "device"), ["device"]),
        "apps_devices.csv": (join_pairs(apps, devices), ["application", "device"]),
    }
    written = {}
    try:
        for name, (df, keys) in outputs.items():
            path = os.path.join(directory, name)
            lines = _with_header_row(df, SUMMARY_HEADERS[name]).orderBy(_ORDER, *keys)
            _shell_writer(lines.drop(_ORDER)).mode("overwrite").csv(path)
            written[name] = path
    finally:
        apps.unpersist()
        devices.unpersist()
    return written


def write_daily(logs: DataFrame, directory: str, mode: str = "errorifexists") -> None:
    """Write logs as headerless 12-field CSV under ``file_date=YYYY-MM-DD/``,
    each part file sorted by user.

    Range partitioning on (file_date, user, ts) gives every task a contiguous
    key range, so one day, or one user holding a third of a day, is spread
    over many tasks and files instead of landing in one.
    """
    if "timestamp" in logs.columns:
        text = F.col("timestamp")
    else:
        text = timestamp_text(F.col("ts"))
    day = F.col("file_date") if "file_date" in logs.columns else F.to_date("ts")
    rows = logs.select(text.alias("timestamp"), "user", "app", *METRICS, "ts", day.alias("file_date"))
    # No fixed partition count: AQE sizes the range partitions at run time.
    out = (
        rows.repartitionByRange("file_date", "user", "ts")
        .sortWithinPartitions("file_date", "user", "ts")
        .drop("ts")
    )
    # Spark's CSV writer keeps the day files' .csv names; log fields hold no
    # newlines, the one place where it differs from csv.writer.
    _csv_writer(out).partitionBy("file_date").mode(mode).csv(directory)


__all__ = ["SUMMARY_HEADERS", "UNIQUE_USERS", "csv_field", "csv_line", "next_result_name", "write_daily", "write_result", "write_summaries"]
