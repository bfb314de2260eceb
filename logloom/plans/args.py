"""Driver-side checks of query arguments, done before any plan is built."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date, datetime

from ..functions.time import check_granularity, parse_datetime_arg

# The grouping dimensions, in the order they appear in results.
DIMENSIONS = ("user", "app")
METRICS = tuple(f"metric_{i}" for i in range(1, 10))


def normalize_list(value) -> tuple[str, ...] | None:
    """A filter list. Text is split on commas and each part stripped; a falsy
    value means no filter. ``","`` therefore filters on the empty string."""
    if value is None:
        return None
    if isinstance(value, str):
        if not value:
            return None
        return tuple(part.strip() for part in value.split(","))
    items = tuple(value)
    if not items:
        return None
    for item in items:
        if not isinstance(item, str):
            raise TypeError(f"filter values must be text, got {item!r}")
    return items


def normalize_dimensions(value) -> tuple[str, ...]:
    """Dimension names in result order (user before app), repeats dropped.

    Text is split on commas and stripped; every name must be ``user`` or
    ``app``, so ``""`` is an error. An empty list means no dimension.
    """
    names: Iterable[str]
    if isinstance(value, str):
        names = [part.strip() for part in value.split(",")]
    else:
        names = list(value)
    for name in names:
        if name not in DIMENSIONS:
            raise ValueError(f"Invalid dimension: {name!r}. Must be 'user', 'app', or 'user,app'")
    return tuple(d for d in DIMENSIONS if d in names)


@dataclass(frozen=True)
class LogQuery:
    """The parameters of one log aggregation, checked."""

    from_dt: datetime
    to_dt: datetime
    granularity: str
    dimensions: tuple[str, ...]
    users: tuple[str, ...] | None
    apps: tuple[str, ...] | None

    @classmethod
    def of(cls, from_dt, to_dt, granularity="1day", dimensions=("user",), users=None, apps=None):
        return cls(
            from_dt=parse_datetime_arg(from_dt),
            to_dt=parse_datetime_arg(to_dt),
            granularity=check_granularity(granularity),
            dimensions=normalize_dimensions(dimensions),
            users=normalize_list(users),
            apps=normalize_list(apps),
        )

    @property
    def first_day(self) -> date:
        return self.from_dt.date()

    @property
    def last_day(self) -> date:
        return self.to_dt.date()

    @property
    def keys(self) -> tuple[str, ...]:
        return ("timestamp", *self.dimensions)
