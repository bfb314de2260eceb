"""Query parameters and the views over the driver's tables."""

from . import fixtures
from .args import DIMENSIONS, METRICS, LogQuery, normalize_dimensions, normalize_list

__all__ = ["DIMENSIONS", "METRICS", "LogQuery", "fixtures", "normalize_dimensions", "normalize_list"]
