"""User–application and user–device pair files.

Half-hour files ``user.<kind>.YYYY-MM-DD-HH-MM.csv`` are found at any depth
under the directory; daily files ``user.<kind>.YYYY-MM-DD.csv`` are read from
the directory itself. Lines are raw text (quotes are not special), split on
commas; the first field is the user and the second the key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.paths import day_in_name
from .logs import CORRUPT, short_row

# The key column of each pair file kind.
PAIR_KINDS = ("application", "device")


def _schema(key: str) -> StructType:
    return StructType([StructField("user", StringType()), StructField(key, StringType()), StructField(CORRUPT, StringType())])


def read_pairs(spark: SparkSession, path: str, kind: str, day=None, recursive: bool = True) -> DataFrame:
    """``user, <kind>, day`` from ``user.<kind>.*.csv`` files.

    ``day`` (``YYYY-MM-DD``) keeps only files named for that day; the glob
    filter drops the other files before they are opened. A line without a
    comma is dropped; an empty field is the empty string; fields past the
    second are ignored.
    """
    if kind not in PAIR_KINDS:
        raise ValueError(f"kind must be one of {PAIR_KINDS}, got {kind!r}")
    glob = f"user.{kind}.{day}-*.csv" if day is not None and recursive else f"user.{kind}.*.csv"
    if day is not None and not recursive:
        glob = f"user.{kind}.{day}.csv"
    raw = (
        spark.read.schema(_schema(kind))
        .option("header", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("quote", "")
        .option("columnPruning", False)
        .option("recursiveFileLookup", recursive)
        .option("pathGlobFilter", glob)
        .csv(path)
    )
    short = short_row(kind, 2, quoted=False)
    return raw.filter(~short).select(
        F.coalesce(F.col("user"), F.lit("")).alias("user"),
        F.coalesce(F.col(kind), F.lit("")).alias(kind),
        day_in_name(F.col("_metadata.file_name")).alias("day"),
    )


def read_daily_pairs(spark: SparkSession, path: str, kind: str = "application") -> DataFrame:
    """Daily pair files directly in ``path`` (not recursive), with their day."""
    return read_pairs(spark, path, kind, day=None, recursive=False).filter(F.col("day").isNotNull())
