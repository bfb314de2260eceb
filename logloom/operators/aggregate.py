"""Metric sums per time bucket (A1–A3) and the run counts of a query.

Input: any DataFrame with ``ts`` (timestamp), ``user``, ``app``,
``metric_1..metric_9`` (integers, or text as read from CSV) and optionally
``file_date``. The plan is filter → bucket → partial sum → exchange on the
group key → final sum: the map-side partial aggregate bounds what one hot
user or app can send through the shuffle to one row per task and group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegralType, StringType

from ..functions.numbers import WIDE, ansi_enabled, checked_sum, int_or_fail, overflow_check, wide_int_or_fail
from ..functions.time import as_wall_clock, date_literal, ntz_literal, period_start, period_text
from ..plans.args import METRICS, LogQuery


def _in_list(df: DataFrame, name: str, values: tuple[str, ...]) -> Column:
    # The raw column keeps the predicate pushable into the scan; an empty
    # field is read as null, so the empty string needs the coalesced form.
    if "" in values:
        return F.coalesce(F.col(name), F.lit("")).isin(list(values))
    return F.col(name).isin(list(values))


def _metric(data_type, name: str, wide: bool = False) -> Column:
    if isinstance(data_type, StringType):
        return wide_int_or_fail(F.col(name), name) if wide else int_or_fail(F.col(name), name)
    whole = isinstance(data_type, IntegralType) or (wide and isinstance(data_type, DecimalType) and data_type.scale == 0)
    if not whole:
        raise TypeError(f"{name} must hold integers or text, not {data_type.simpleString()}")
    # A null stops the query as unreadable text does.
    kind = WIDE if wide else "bigint"
    missing = F.raise_error(F.lit(f"null in {name}")).cast(kind)
    return F.coalesce(F.col(name).cast(kind), missing)


def matching_rows(logs: DataFrame, query: LogQuery, keep: tuple[str, ...] = (), wide: bool = False) -> DataFrame:
    """Rows inside the query's filters: ``ts`` (NTZ), the ``keep`` columns,
    the dimensions (an empty field as ``''``) and the nine metrics as
    ``BIGINT``, or ``DECIMAL(38,0)`` when ``wide``.

    Filter order follows the reference's optimized reader: users, apps, time
    range and file day first; metric text is parsed only afterwards, so a bad
    metric fails the query only in a row that matches.
    """
    df = logs
    schema = logs.schema
    if query.users is not None:
        df = df.filter(_in_list(df, "user", query.users))
    if query.apps is not None:
        df = df.filter(_in_list(df, "app", query.apps))
    ts = as_wall_clock(F.col("ts"), schema["ts"].dataType)
    df = df.filter((ts >= ntz_literal(query.from_dt)) & (ts < ntz_literal(query.to_dt)))
    if "file_date" in schema.fieldNames():
        # The file's own day bounds the rows too (P4), independently of ts.
        df = df.filter(
            F.col("file_date").between(date_literal(query.first_day), date_literal(query.last_day))
        )
    dims = [F.coalesce(F.col(d), F.lit("")).alias(d) for d in query.dimensions]
    metrics = [_metric(schema[m].dataType, m, wide).alias(m) for m in METRICS]
    return df.select(ts.alias("ts"), *keep, *dims, *metrics)


def aggregate_logs(
    logs: DataFrame,
    from_dt,
    to_dt,
    granularity: str = "1day",
    dimensions=("user",),
    users=None,
    apps=None,
    ordered: bool = False,
    observation=None,
    wide: bool = False,
) -> DataFrame:
    """Sum ``metric_1..metric_9`` per (period[, user][, app]).

    Result columns: ``timestamp`` (period start as ``YYYY-MM-DD HH:MM:SS``),
    the chosen dimensions in the order user, app, then the nine sums. Rows
    are in range when ``from_dt <= ts < to_dt``. ``ordered=True`` sorts by
    the key, as the written result is. An ``Observation`` given as
    ``observation`` receives ``rows_matched`` from whichever action runs the
    query, without a second pass over the input. Metrics and sums are 64-bit
    integers, or with ``wide=True`` whole numbers of up to 38 digits; beyond
    either the query stops.
    """
    query = LogQuery.of(from_dt, to_dt, granularity, dimensions, users, apps)
    rows = matching_rows(logs, query, wide=wide)
    if observation is not None:
        rows = rows.observe(observation, F.count(F.lit(1)).alias("rows_matched"))
    period = period_start(F.col("ts"), query.granularity).alias("period")
    ansi = ansi_enabled(logs.sparkSession)
    grouped = rows.groupBy(period, *query.dimensions).agg(*[checked_sum(F.col(m), m, ansi) for m in METRICS])
    if ordered:
        # Sorting on the NTZ period orders exactly as its text does, and is cheaper.
        grouped = grouped.orderBy("period", *query.dimensions)
    return grouped.select(
        period_text(F.col("period")).alias("timestamp"),
        *query.dimensions,
        *[overflow_check(F.col(m), m).alias(m) for m in METRICS],
    )


def run_counts(
    logs: DataFrame,
    from_dt,
    to_dt,
    granularity: str = "1day",
    dimensions=("user",),
    users=None,
    apps=None,
    files: DataFrame | None = None,
    wide: bool = False,
) -> DataFrame:
    """One row: ``files`` present in the day range, ``rows_matched``, ``groups``;
    like the sums, it fails on a bad metric in a matching row (``wide`` as there).

    ``files`` is a day listing with a ``day`` column (empty files included,
    see ``sources.day_calendar``); without it the days come from the rows'
    ``file_date``. The files count is a scalar subquery, not a join.
    """
    query = LogQuery.of(from_dt, to_dt, granularity, dimensions, users, apps)
    days = files.select("day") if files is not None else logs.select(F.col("file_date").alias("day"))
    in_range = F.col("day").between(date_literal(query.first_day), date_literal(query.last_day))
    n_files = days.filter(in_range).select(F.count_distinct("day")).scalar()
    period = period_start(F.col("ts"), query.granularity).alias("period")
    # Each matching row's metrics are read, so a bad one stops the counts as
    # it stops the sums (a parsed metric is never null: every row counts).
    read_all = F.greatest(*[F.col(m) for m in METRICS])
    per_group = (
        matching_rows(logs, query, wide=wide)
        .groupBy(period, *query.dimensions)
        .agg(F.count(read_all).alias("n"))
    )
    totals = per_group.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("rows_matched"),
        F.count(F.lit(1)).alias("groups"),
    )
    return totals.select(n_files.alias("files"), "rows_matched", "groups")
