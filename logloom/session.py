"""Session helpers for tests, tools and the bench (a cluster brings its own).

``local_session`` sets what a local run needs: AQE on (runtime coalescing,
skew-join splitting, broadcast only after a stage's real size is known),
shuffle partitions sized to the cores, the UI off, no per-call Python call
site capture. ``checkpoint_dir`` reads
the shared folder a cluster names in ``spark.checkpoint.dir`` and sets a
scratch one only when a local session has none.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | None = None, shuffle_partitions: int | None = None, **conf) -> SparkSession:
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("logloom")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        # Skip capturing a Python call site on every functions.* call: three
        # extra driver round trips each, and plans here are built per query.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; a fresh scratch folder only
    when none is set (local runs)."""
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = "file://" + tempfile.mkdtemp(prefix="logloom-ckpt-")
    spark.sparkContext.setCheckpointDir(path)
    spark.conf.set("spark.checkpoint.dir", path)
    return path
