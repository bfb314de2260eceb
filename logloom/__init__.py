"""logloom: application-usage log analytics as Spark DataFrame queries."""

from .operators import (
    UNIQUE_USERS,
    aggregate_logs,
    app_device_pairs,
    everyday_users,
    repo_roots,
    repo_sizes,
    run_counts,
    unique_users,
)

__all__ = [
    "UNIQUE_USERS",
    "aggregate_logs",
    "app_device_pairs",
    "everyday_users",
    "repo_roots",
    "repo_sizes",
    "run_counts",
    "unique_users",
]
