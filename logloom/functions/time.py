"""Wall-clock time columns: strict timestamp text, period floors, period text.

Every timestamp here is ``TIMESTAMP_NTZ``: log times carry no zone, so the
buckets and the printed periods must not move with the session time zone.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

# The text format of log timestamps and of printed periods, and
# the two granularities with the interval each one floors to.
TIMESTAMP_FORMAT = "%Y-%m-%d %H:%M:%S"
GRANULARITIES = {"30m": "30 minutes", "1day": "1 day"}

# Text that a strict "%Y-%m-%d %H:%M:%S" parse accepts: fields may be unpadded,
# a one-digit day may carry one leading space, any whitespace run separates
# date and time, nothing may precede or follow, and year 0000 does not exist.
STRICT_TIMESTAMP_RX = (
    r"^(?!0000)[0-9]{4}-(?:1[0-2]|0[1-9]|[1-9])-(?:3[01]|[12][0-9]|0[1-9]|[1-9]| [1-9])"
    r"\s+(?:2[0-3]|[01][0-9]|[0-9]):(?:[0-5][0-9]|[0-9]):(?:[0-5][0-9]|[0-9])\z"
)
# Rewrites accepted text into the one spacing Spark's cast reads.
_RESPACE_RX = r"^([0-9]{4}-[0-9]{1,2}-) ?([0-9]{1,2})\s+"


def parse_timestamp_text(text: Column) -> Column:
    """Timestamp text to ``TIMESTAMP_NTZ``; null when the strict format fails.

    Impossible dates (Feb 30) pass the pattern and fail the cast, so they are
    null too.
    """
    respaced = F.regexp_replace(text, _RESPACE_RX, "$1$2 ")
    return F.when(text.rlike(STRICT_TIMESTAMP_RX), respaced.try_cast("timestamp_ntz"))


def as_wall_clock(ts: Column, data_type) -> Column:
    """Make a timestamp column NTZ. A zoned ``TIMESTAMP`` becomes its local
    wall-clock time in the session zone."""
    if isinstance(data_type, TimestampNTZType):
        return ts
    if isinstance(data_type, TimestampType):
        return ts.cast("timestamp_ntz")
    raise TypeError(f"ts must be a timestamp column, got {data_type.simpleString()}")


def period_start(ts: Column, granularity: str) -> Column:
    """Floor an NTZ timestamp to the start of its 30-minute or day bucket.

    Built on ``window``, which compiles to long arithmetic on the timestamp
    and drops null timestamps; Spark allows one such column per projection.
    """
    return F.window(ts, GRANULARITIES[check_granularity(granularity)]).start


def period_text(period: Column) -> Column:
    """Print a period start as ``strftime("%Y-%m-%d %H:%M:%S")`` does.

    A cast, not ``date_format``: the cast of an NTZ value never goes through a
    zone, so a time inside a DST gap still prints as itself. ``%Y`` does not
    pad years below 1000 (year 1 prints as ``1``), so leading zeros of the
    year are cut. A long comparison keeps that regex off every period from
    year 1000 on, so it is not paid once per group of a near-unique key.
    """
    text = period.cast("string")
    return F.when(period >= F.lit("1000-01-01 00:00:00").cast("timestamp_ntz"), text).otherwise(F.regexp_replace(text, r"^0{1,3}(?=[0-9]{1,3}-)", ""))


def timestamp_text(ts: Column) -> Column:
    """Whole-second text of an NTZ timestamp (fractions cut), as written to logs."""
    return F.substring(ts.cast("string"), 1, 19)


def check_granularity(granularity: str) -> str:
    if granularity not in GRANULARITIES:
        raise ValueError(
            f"Invalid granularity: {granularity!r}; expected one of {sorted(GRANULARITIES)}"
        )
    return granularity


def parse_datetime_arg(value) -> datetime:
    """A range bound: text in the strict log format, or a ``datetime``."""
    if isinstance(value, datetime):
        return value
    if isinstance(value, str):
        return datetime.strptime(value, TIMESTAMP_FORMAT)
    raise TypeError(f"expected 'YYYY-MM-DD HH:MM:SS' text or datetime, got {value!r}")


def parse_date_arg(value) -> date:
    if isinstance(value, datetime):
        return value.date()
    if isinstance(value, date):
        return value
    if isinstance(value, str):
        return datetime.strptime(value, "%Y-%m-%d").date()
    raise TypeError(f"expected 'YYYY-MM-DD' text or date, got {value!r}")


def ntz_literal(value: datetime) -> Column:
    """An NTZ literal. ``F.lit(datetime)`` would be a zoned ``TIMESTAMP`` taken
    from the Python process's local zone."""
    text = value.strftime("%Y-%m-%d %H:%M:%S")
    if value.microsecond:
        text += f".{value.microsecond:06d}"
    return F.lit(text).cast("timestamp_ntz")


def date_literal(value: date) -> Column:
    return F.lit(value.isoformat()).cast("date")
