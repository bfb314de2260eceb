"""Daily application logs: headerless CSV, 12 fields per row.

Two layouts are read:

* ``flat``: one ``YYYY-MM-DD.log.csv`` per day in one directory, the
  reference's layout. The day comes from ``_metadata.file_name``; a filter on
  it prunes files before they are opened.
* ``daily``: ``file_date=YYYY-MM-DD/`` directories as ``sinks.write_daily``
  writes them; ``file_date`` is a partition column and prunes directories.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.paths import day_in_name
from ..functions.time import date_literal, parse_datetime_arg, parse_timestamp_text
from ..plans.args import METRICS
from .listing import list_dir
from .quoted import files_with_quotes, quoted_records, text_lines

# Field order of a log row and the day-file name.
LOG_FIELDS = ("timestamp", "user", "app", *METRICS)
DAY_FILE_GLOB = "*.log.csv"
DAY_FILE_RX = r"^([0-9]{4}-[0-9]{2}-[0-9]{2})\.log\.csv$"
DAY_FILE_SUFFIX = ".log.csv"
CORRUPT = "_corrupt_record"

LOG_SCHEMA = StructType([StructField(n, StringType()) for n in LOG_FIELDS] + [StructField(CORRUPT, StringType())])


def csv_reader(spark: SparkSession, schema: StructType):
    """Spark's CSV reader for lines: comma, double quote, a doubled quote inside
    quotes, no header, every field kept as text.

    Column pruning is off so that a wrong field count always shows in
    ``_corrupt_record``, whatever columns the query selects.
    """
    return (
        spark.read.schema(schema)
        .option("header", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("escape", '"')
        .option("columnPruning", False)
    )


def detect_layout(spark: SparkSession, path: str) -> str:
    """``daily`` or ``flat``; a directory that holds both is an error, since reading
    it as either would leave the other's rows out."""
    entries = list_dir(spark, path)
    daily = next((e.name for e in entries if e.is_dir and e.name.startswith("file_date=")), None)
    flat = next((e.name for e in entries if not e.is_dir and re.match(DAY_FILE_RX, e.name)), None)
    if daily and flat:
        raise ValueError(f"{path} holds both layouts ({daily} and {flat}): keep them in directories of their own")
    return "daily" if daily else "flat"


def read_logs(
    spark: SparkSession,
    path: str,
    from_dt=None,
    to_dt=None,
    quotes: str = "exact",
    layout: str = "auto",
) -> DataFrame:
    """Log rows as ``timestamp`` (text), ``user``, ``app``,
    ``metric_1..metric_9`` (text), ``ts`` (``TIMESTAMP_NTZ``), ``file_date``.

    Dropped: rows with fewer than 12 fields (fields past the 12th are
    ignored), rows whose timestamp text is not strictly
    ``YYYY-MM-DD HH:MM:SS``, files whose name holds no valid day. Given a
    range, only files for days ``from.date .. to.date`` are read. Metric text
    is left for ``aggregate_logs`` to parse after its filters, and a missing
    day file is simply absent.

    Records are those of Python's csv module, fields with line ends, text
    after a closing quote and unclosed quotes included. A pass over the lines
    first names the files that hold a quote at all (its only result on the
    driver); these go through the quote-exact scan, the rest through Spark's
    CSV reader, both in splits. ``quotes="none"`` leaves that pass out, on the
    caller's word that no file holds a quote.
    """
    if quotes not in ("exact", "none"):
        raise ValueError(f"quotes must be 'exact' or 'none', got {quotes!r}")
    found = detect_layout(spark, path)
    if layout == "auto":
        layout = found
    reader = csv_reader(spark, LOG_SCHEMA)
    first, last = _day_range(from_dt, to_dt)
    if layout == "flat":
        raw = reader.option("pathGlobFilter", DAY_FILE_GLOB).csv(path)
        name = F.col("_metadata.file_name")
        day = day_in_name(name, DAY_FILE_RX)
        # Day-file names sort in date order: a plain text range on the name
        # prunes files before they are opened, without a regex per row.
        prune = None if first is None else name.between(f"{first}{DAY_FILE_SUFFIX}", f"{last}{DAY_FILE_SUFFIX}")
    elif layout == "daily":
        raw = reader.csv(path)
        day = F.col("file_date").cast("date")
        prune = None if first is None else day.between(date_literal(first), date_literal(last))
    else:
        raise ValueError(f"layout must be 'auto', 'flat' or 'daily', got {layout!r}")
    if prune is not None:
        raw = raw.filter(prune)
    if quotes == "none":
        return clean_log_rows(raw, day, first, last)
    lines = text_lines(spark, path, DAY_FILE_GLOB if layout == "flat" else None, prune, day)
    quoted = files_with_quotes(lines)
    if not quoted:
        return clean_log_rows(raw, day, first, last)
    here = F.col("_metadata.file_path").isin(quoted)
    quoted_lines = text_lines(spark, path, DAY_FILE_GLOB if layout == "flat" else None, here if prune is None else prune & here, day)
    exact = _log_fields(quoted_records(quoted_lines), first, last)
    return clean_log_rows(raw.filter(~here), day, first, last).unionByName(exact)


def logs_from_lines(lines: DataFrame, value: str = "value", file_date: str = "file_date") -> DataFrame:
    """``read_logs`` of a table of raw log lines, one record a row (``value``), with
    the day of the file they came from: the same rules for fields, timestamps and
    short rows."""
    schema = ", ".join(f"{f.name} string" for f in LOG_SCHEMA)
    parsed = F.from_csv(F.col(value), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "escape": '"'})
    raw = lines.select(parsed.alias("record"), F.col(file_date).cast("date").alias("_day")).select("record.*", "_day")
    return clean_log_rows(raw, F.col("_day"))


def _day_range(from_dt, to_dt):
    if from_dt is None or to_dt is None:
        return None, None
    return parse_datetime_arg(from_dt).date(), parse_datetime_arg(to_dt).date()


def _log_fields(records: DataFrame, first, last) -> DataFrame:
    """Log rows of whole records (file_date, fields); an empty field is null, as
    Spark's CSV reader has it."""
    long_enough = records.filter(F.size("fields") >= len(LOG_FIELDS))
    return _timed(long_enough.select(*[F.nullif(F.get("fields", F.lit(i)), F.lit("")).alias(n) for i, n in enumerate(LOG_FIELDS)], "file_date"), first, last)


# A quoted field, where a field may start (line start or after a comma):
# doubled quotes inside, up to its closing quote.
_QUOTED_FIELD_RX = r'(^|,)"(?:[^"]|"")*"'


def has_fields(line: Column, n: int, quoted: bool = True) -> Column:
    """A raw CSV line holds at least ``n`` fields: quoted field bodies are cut
    out, then the commas counted."""
    bare = F.regexp_replace(line, _QUOTED_FIELD_RX, "$1") if quoted else line
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) >= n - 1


def short_row(last_field: str, n_fields: int, quoted: bool = True) -> Column:
    """A row with fewer than ``n_fields`` fields.

    Spark flags a row with fewer *or more* fields than the schema in
    ``_corrupt_record`` and reads an empty field as null, so a flagged row
    with a null last field is either short or long with that field empty.
    Only such rows, rare, have their raw line's fields counted; ``AND`` stops
    at the first false term for every other row.
    """
    return F.col(CORRUPT).isNotNull() & F.col(last_field).isNull() & ~has_fields(F.col(CORRUPT), n_fields, quoted)


def clean_log_rows(raw: DataFrame, day: Column, first=None, last=None) -> DataFrame:
    """Apply the row rules to a raw scan: short rows out, strict timestamps,
    the file's ``day`` (null for names without a valid day) within
    ``first..last`` when given. Shared by the batch and the streaming reader.

    ``ts`` comes out of a one-row ``inline``: Spark inlines a projected
    expression into every later filter that uses it (the checks here, the
    range of the query), so the timestamp pattern would run once per use; a
    generator's output is computed once per row. ``file_date`` stays outside
    it: filters on it, and on the raw columns (users, apps), pass below to
    the scan, where a range of days leaves the other days' files unread.
    """
    short = short_row(METRICS[-1], len(LOG_FIELDS))
    return _timed(raw.filter(~short).select(*LOG_FIELDS, day.alias("file_date")), first, last)


def _timed(rows: DataFrame, first, last) -> DataFrame:
    parsed = F.struct(parse_timestamp_text(F.col("timestamp")).alias("ts"))
    rows = rows.select(*LOG_FIELDS, "file_date", F.inline(F.array(parsed)))
    keep = F.col("ts").isNotNull() & F.col("file_date").isNotNull()
    if first is not None:
        keep = keep & F.col("file_date").between(date_literal(first), date_literal(last))
    return rows.filter(keep)
