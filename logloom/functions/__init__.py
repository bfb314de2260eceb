"""Column functions (built-in Spark expressions only)."""

from .numbers import int_or_fail, overflow_check, parse_int_text
from .paths import ancestors_and_self, ceil_mib, day_in_name, explode_ancestors, git_root, parent_path
from .time import (
    GRANULARITIES,
    TIMESTAMP_FORMAT,
    as_wall_clock,
    date_literal,
    ntz_literal,
    parse_date_arg,
    parse_datetime_arg,
    parse_timestamp_text,
    period_start,
    period_text,
    timestamp_text,
)

__all__ = [
    "GRANULARITIES",
    "TIMESTAMP_FORMAT",
    "ancestors_and_self",
    "as_wall_clock",
    "ceil_mib",
    "date_literal",
    "day_in_name",
    "explode_ancestors",
    "git_root",
    "int_or_fail",
    "ntz_literal",
    "overflow_check",
    "parent_path",
    "parse_date_arg",
    "parse_datetime_arg",
    "parse_int_text",
    "parse_timestamp_text",
    "period_start",
    "period_text",
    "timestamp_text",
]
