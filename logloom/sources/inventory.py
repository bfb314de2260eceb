"""File inventories (S10): ``path, kind, bytes`` rows, one per file or
directory, from any table source (a listing dump, a catalog export)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

INVENTORY_SCHEMA = "path string, kind string, bytes bigint"


def read_inventory(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """``path`` (absolute, ``/``-separated), ``kind`` (``file`` or ``dir``),
    ``bytes`` (apparent size), one row per entry of a real tree: a path is a
    file or a directory, not both. CSV inventories are headerless."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.schema(INVENTORY_SCHEMA).option("escape", '"')
    df = reader.load(path)
    return df.select(F.col("path").cast("string"), F.col("kind").cast("string"), F.col("bytes").cast("bigint"))
