"""Path and file-name columns: dates in names, ancestors, repository roots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A day as it appears inside file names, and the MiB size as a
# power of two (1 MiB = 2**20 bytes).
DAY_IN_NAME_RX = r"([0-9]{4}-[0-9]{2}-[0-9]{2})"
MIB_SHIFT = 20


def day_in_name(name: Column, pattern: str = DAY_IN_NAME_RX) -> Column:
    """The day captured by ``pattern`` in a file name, as ``DATE``; null if
    the name holds none or it is not a real date."""
    text = F.regexp_extract(name, pattern, 1)
    return F.when(text != "", text.try_cast("date"))


def ancestors_and_self(path: Column) -> Column:
    """Every directory above ``path`` plus the path itself, as an array.

    ``/c/0/7/o1`` gives ``[/c, /c/0, /c/0/7, /c/0/7/o1]``; a relative path
    starts at its first component; trailing slashes are ignored. The file-system
    root is left out; ``explode_ancestors`` has it.
    """
    p = without_trailing_slash(path)
    slashes = F.length(p) - F.length(F.replace(p, F.lit("/"), F.lit("")))
    first = F.when(p.startswith("/"), F.lit(2)).otherwise(F.lit(1))
    levels = F.sequence(first, slashes + 1)
    return F.transform(levels, lambda k: F.call_function("substring_index", p, F.lit("/"), k))


def explode_ancestors(df: DataFrame, path: str, out: str, *keep: str) -> DataFrame:
    """One row per (row, ancestor-or-self of ``path``) as column ``out``,
    with the ``keep`` columns carried along. The file-system root is an
    ancestor of every absolute path; the empty path has no row.

    ``posexplode`` over the path's components, then one ``substring_index``
    per output row: both compile to Java code, unlike a lambda over an array.
    """
    p = without_trailing_slash(F.col(path))
    parts = df.select(p.alias("_p"), *keep).select("_p", *keep, F.posexplode(F.split("_p", "/", -1)).alias("_i", "_c"))
    # The empty component before a leading slash stands for the root.
    top = (F.col("_i") == 0) & (F.col("_c") == "")
    parts = parts.filter(~top | (F.length("_p") > 1))
    return parts.select(
        F.when(top, F.lit("/")).otherwise(F.call_function("substring_index", F.col("_p"), F.lit("/"), F.col("_i") + 1)).alias(out), *keep
    )


def without_trailing_slash(path: Column) -> Column:
    return F.when((F.length(path) > 1) & path.endswith("/"), F.rtrim(path, F.lit("/"))).otherwise(path)


def parent_path(path: Column) -> Column:
    """The directory part of a path (``/a/b/f`` → ``/a/b``; ``/f`` → ``/``; ``f`` →
    ``''``), cut by length arithmetic rather than a pattern."""
    last = F.call_function("substring_index", path, F.lit("/"), F.lit(-1))
    size = F.length(path) - F.length(last) - 1
    return F.when((size == 0) & path.startswith("/"), F.lit("/")).otherwise(F.call_function("substring", path, F.lit(1), F.greatest(size, F.lit(0))))


def git_root(path: Column) -> Column:
    """Parent of a path ending in ``/.git`` (trailing slashes aside), the file-system
    root for ``/.git``; null otherwise."""
    p = without_trailing_slash(path)
    size = F.length(p) - F.lit(len("/.git"))
    return F.when(p.endswith("/.git"), F.when(size > 0, F.left(p, size)).otherwise(F.lit("/")))


def ceil_mib(n_bytes: Column) -> Column:
    """Bytes to whole MiB rounded up, exact: ``(n + 2**20 - 1) >> 20``."""
    return F.shiftright(n_bytes + F.lit((1 << MIB_SHIFT) - 1), MIB_SHIFT)
