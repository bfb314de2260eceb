"""Repository sizes over a file inventory.

A repository root is the parent of a directory named ``.git``. Its size is
the apparent size of everything under it, itself included, and nested
repositories are counted in full in each enclosing one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import ansi_enabled, checked_sum, overflow_check
from ..functions.paths import ceil_mib, explode_ancestors, git_root, parent_path, without_trailing_slash


def repo_roots(inventory: DataFrame) -> DataFrame:
    """Distinct ``root`` of every ``.git`` directory (a ``.git`` file is no root)."""
    return (
        inventory.filter(F.col("kind") == "dir")
        .select(git_root(F.col("path")).alias("root"))
        .filter(F.col("root").isNotNull())
        .distinct()
    )


def repo_sizes(inventory: DataFrame, min_mib: int = 1024) -> DataFrame:
    """``root, size_mb`` for repositories whose size, rounded up to whole MiB,
    is greater than ``min_mib``.

    No join. A file's bytes are first summed into its own directory (map-side,
    then one exchange), so what follows works on directories, not files. The
    directories are laid out by path, neighbours together, and each is credited
    to itself and every directory above it: a task's partial sums are those of
    the directories in its range and the few above them, so what is shuffled is
    bounded by the directories, not by files times depth. A ``.git`` directory
    also marks its parent as a root; directories without a mark are dropped.
    """
    is_dir = F.col("kind") == "dir"
    ansi = ansi_enabled(inventory.sparkSession)
    own = inventory.select(
        F.when(is_dir, without_trailing_slash(F.col("path"))).otherwise(parent_path(F.col("path"))).alias("path"),
        F.coalesce("bytes", F.lit(0)).alias("bytes"),
        is_dir.alias("listed"),
    )
    directories = own.groupBy("path").agg(checked_sum(F.col("bytes"), "bytes", ansi), F.bool_or("listed").alias("listed"))
    directories = directories.select(
        "path", overflow_check(F.col("bytes"), "bytes").alias("bytes"), F.when(F.col("listed"), git_root(F.col("path"))).alias("_root_of")
    ).repartitionByRange("path")
    rolled = (
        explode_ancestors(directories, "path", "root", "bytes", "_root_of")
        .groupBy("root")
        .agg(
            checked_sum(F.col("bytes"), "bytes", ansi),
            F.bool_or(F.coalesce(F.col("root") == F.col("_root_of"), F.lit(False))).alias("is_root"),
        )
    )
    return rolled.filter("is_root").select("root", ceil_mib(overflow_check(F.col("bytes"), "bytes")).alias("size_mb")).filter(
        F.col("size_mb") > F.lit(min_mib)
    )
