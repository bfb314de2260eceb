"""Query operators: functions from DataFrames to a lazy DataFrame."""

from .aggregate import aggregate_logs, matching_rows, run_counts
from .inventory import repo_roots, repo_sizes
from .usage import UNIQUE_USERS, app_device_pairs, everyday_users, unique_users

__all__ = [
    "UNIQUE_USERS",
    "aggregate_logs",
    "app_device_pairs",
    "everyday_users",
    "matching_rows",
    "repo_roots",
    "repo_sizes",
    "run_counts",
    "unique_users",
]
