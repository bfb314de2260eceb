"""Who uses what: unique users per key (A4, A5), application–device pairs
sharing a user (J1), users active on every day up to a date (J2).

Pair tables have ``user`` and a key (``application`` or ``device``) and, for
day-bound questions, ``day``. Every step dedupes before it shuffles, so a
user with a third of all rows arrives at any exchange as at most one row per
distinct (user, key) or (user, day).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.time import date_literal, parse_date_arg

# Fixed value: the count column name of the reference's summary files.
UNIQUE_USERS = "number of unique users"
#: Keys of one user that a join task meets on each side.
BLOCK_KEYS = 4096


def _on_day(pairs: DataFrame, day) -> DataFrame:
    if day is None:
        return pairs
    return pairs.filter(F.col("day") == date_literal(parse_date_arg(day)))


def user_keys(pairs: DataFrame, key: str, day=None) -> DataFrame:
    """Distinct ``user, key`` of ``pairs`` (on ``day`` if given): the deduped
    side that the unique counts and the pair join both start from."""
    return _on_day(pairs, day).select("user", key).distinct()


def count_users(keys: DataFrame, key: str) -> DataFrame:
    """``key, "number of unique users"`` over distinct ``user, key`` rows."""
    return keys.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("user").alias(UNIQUE_USERS))


def blocked_join(apps: DataFrame, devices: DataFrame, block_keys: int = BLOCK_KEYS) -> DataFrame:
    """``user, application, device`` over distinct ``user, application`` and ``user,
    device`` rows that share a user.

    A user's pairs are its applications times its devices, so a user with very
    many of both would keep one task busy for the square. Users with more than
    ``block_keys`` of either are cut into blocks on both sides, as many as their
    own counts ask for: an application goes to its block once for each device
    block, a device likewise, and each pair of blocks is a join key of its own,
    of at most about ``block_keys`` squared pairs. Every pair meets exactly once.
    """

    def blocks(keys: DataFrame, name: str) -> DataFrame:
        return keys.groupBy("user").agg(F.ceil(F.count(F.lit(1)) / block_keys).cast("int").alias(name))

    hot = blocks(apps, "app_blocks").join(blocks(devices, "device_blocks"), "user").where("app_blocks > 1 or device_blocks > 1")

    def dealt(keys: DataFrame, key: str, own: str, other: str, own_count: str, other_count: str) -> DataFrame:
        known = keys.join(hot, "user", "left")
        mine = F.pmod(F.xxhash64(key), F.coalesce(own_count, F.lit(1))).cast("int")
        return known.select("user", key, mine.alias(own), F.explode(F.sequence(F.lit(0), F.coalesce(other_count, F.lit(1)) - 1)).alias(other))

    left = dealt(apps, "application", "app_block", "device_block", "app_blocks", "device_blocks")
    right = dealt(devices, "device", "device_block", "app_block", "device_blocks", "app_blocks")
    return left.join(right, ["user", "app_block", "device_block"], "inner").select("user", "application", "device")


def join_pairs(apps: DataFrame, devices: DataFrame, block_keys: int = BLOCK_KEYS) -> DataFrame:
    """Distinct ``application, device`` over distinct ``user, application``
    and ``user, device`` rows that share a user."""
    return blocked_join(apps, devices, block_keys).select("application", "device").distinct()


def unique_users(pairs: DataFrame, key: str, day=None) -> DataFrame:
    """``key, "number of unique users"``; repeated pairs count once.

    The pairs are deduped map-side and again after an exchange on
    (user, key); the count per key is then a partial and final count:
    skew-safe, since a hot key reaches the last exchange as one partial row
    per task.
    """
    return count_users(user_keys(pairs, key, day), key)


def app_device_pairs(user_app: DataFrame, user_device: DataFrame, day=None) -> DataFrame:
    """Distinct ``application, device`` that share at least one user.

    Both sides are deduped to (user, key) first, so per user the join meets
    at most its distinct applications and devices, in blocks where these are
    many (``blocked_join``); the pairs it produces are deduped map-side in the
    join's own stage before the final exchange.
    """
    return join_pairs(user_keys(user_app, "application", day), user_keys(user_device, "device", day))


def everyday_users(user_app: DataFrame, day, application: str, calendar: DataFrame | None = None) -> DataFrame:
    """Users of ``application`` on every listed day up to and including ``day``.

    Relational division by counting: per user, the distinct days with the
    application must equal the number of calendar days ≤ ``day``.
    ``calendar`` (a ``day`` column) should list every day that has a file,
    empty files included, and only its days count; without it the days present
    in ``user_app`` are used. No day ≤ ``day`` is a ``ValueError``.
    """
    last = date_literal(parse_date_arg(day))
    days = (calendar if calendar is not None else user_app).select("day").filter(F.col("day") <= last)
    # One aggregate job brings the day count, a single number, to the driver:
    # it is both the error check (with no day the query's input is empty too,
    # so a check inside it would never run) and the divisor, so the calendar
    # is computed once.
    needed = days.agg(F.count_distinct("day").alias("n")).first()["n"]
    if needed == 0:
        raise ValueError(f"No files found for date <= {parse_date_arg(day)}")
    active = (
        user_app.filter((F.col("application") == F.lit(application)) & (F.col("day") <= last))
        .select("user", "day")
        .distinct()
    )
    if calendar is not None:  # days that the calendar lacks must not make up for days that it has
        active = active.join(days.distinct(), "day", "left_semi")
    active = active.groupBy("user").agg(F.count(F.lit(1)).alias("n_days"))
    return active.filter(F.col("n_days") == F.lit(needed)).select("user")
