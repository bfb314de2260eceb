"""Readers: daily log CSV, pair CSV, day listings, inventories."""

from .inventory import read_inventory
from .listing import day_calendar, list_dir
from .logs import LOG_FIELDS, LOG_SCHEMA, logs_from_lines, read_logs
from .pairs import read_daily_pairs, read_pairs
from .walk import days_listed, walk

__all__ = [
    "LOG_FIELDS",
    "LOG_SCHEMA",
    "day_calendar",
    "days_listed",
    "list_dir",
    "logs_from_lines",
    "read_daily_pairs",
    "read_inventory",
    "read_logs",
    "read_pairs",
    "walk",
]
