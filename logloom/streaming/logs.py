"""The log aggregation over day files as they arrive (Structured Streaming).

The same scan rules and filters as the batch path, read incrementally from a
directory of ``YYYY-MM-DD.log.csv`` files, with the time buckets kept as
event-time windows in the streaming state. A bucket is emitted once, when
the watermark (latest event time minus ``lateness``) passes its end; rows
that arrive later than that are dropped, as in any watermarked stream.

Spark accepts watermarks on zoned ``TIMESTAMP`` only, so the stream runs in
its own session pinned to UTC: there the wall-clock time cast to
``TIMESTAMP``, its UTC-aligned windows and the cast back are all exact, and
the buckets equal the batch ones whatever the caller's session zone.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.numbers import ansi_enabled, checked_sum, overflow_check
from ..functions.paths import day_in_name
from ..functions.time import GRANULARITIES
from ..operators.aggregate import matching_rows
from ..plans.args import METRICS, LogQuery
from ..session import checkpoint_dir
from ..sources.logs import DAY_FILE_GLOB, DAY_FILE_RX, LOG_SCHEMA, clean_log_rows

UTC = "UTC"


def utc_session(spark: SparkSession) -> SparkSession:
    """A session sharing ``spark``'s context and catalog, with its own SQL
    conf pinned to UTC."""
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", UTC)
    return session


def stream_logs(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A streaming ``read_logs`` of the flat layout (one file per day)."""
    session = utc_session(spark)
    reader = (
        session.readStream.schema(LOG_SCHEMA)
        .option("header", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .option("escape", '"')
        .option("columnPruning", False)
        .option("pathGlobFilter", DAY_FILE_GLOB)
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.csv(path)
    return clean_log_rows(raw, day_in_name(F.col("_metadata.file_name"), DAY_FILE_RX))


def aggregate_logs_stream(
    logs: DataFrame,
    from_dt,
    to_dt,
    granularity: str = "1day",
    dimensions=("user",),
    users=None,
    apps=None,
    lateness: str = "1 day",
) -> DataFrame:
    """``aggregate_logs`` over a stream from ``stream_logs``; for append mode.

    Spark pushes the query's filters below the watermark, so the watermark
    follows the rows the query keeps: a bucket closes once a kept row is
    ``lateness`` past its end. Only the bucket state is kept, one entry per
    open (bucket, dimensions) group, and it is dropped when the bucket closes.
    """
    if logs.sparkSession.conf.get("spark.sql.session.timeZone") != UTC:
        raise ValueError("aggregate_logs_stream needs the UTC session of stream_logs")
    query = LogQuery.of(from_dt, to_dt, granularity, dimensions, users, apps)
    timed = logs.withColumn("event_time", F.col("ts").cast("timestamp")).withWatermark("event_time", lateness)
    rows = matching_rows(timed, query, keep=("event_time",))
    window = F.window("event_time", GRANULARITIES[query.granularity])
    grouped = (
        rows.groupBy(window.alias("window"), *query.dimensions)
        .agg(*[checked_sum(F.col(m), m, ansi_enabled(logs.sparkSession)) for m in METRICS])
    )
    return grouped.select(
        F.col("window.start").cast("timestamp_ntz").cast("string").alias("timestamp"),
        *query.dimensions,
        *[overflow_check(F.col(m), m).alias(m) for m in METRICS],
    )


def start_csv_stream(result: DataFrame, directory: str, name: str, checkpoint: str | None = None) -> StreamingQuery:
    """Append finished buckets as CSV part files under ``directory``, in the
    batch sink's dialect.

    The checkpoint goes under the session's ``spark.checkpoint.dir`` (shared
    storage on a cluster) unless one is given, so a restarted query resumes
    where it stopped.
    """
    location = checkpoint or os.path.join(checkpoint_dir(result.sparkSession), f"logloom-stream-{name}")
    return (
        result.writeStream.outputMode("append")
        .format("csv")
        .option("header", True)
        .option("lineSep", "\r\n")
        .option("escape", '"')
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("checkpointLocation", location)
        .queryName(name)
        .start(directory)
    )
