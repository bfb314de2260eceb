"""File listings through the Hadoop FileSystem of the session (driver side,
metadata only: names and sizes, never file contents)."""

from __future__ import annotations

import fnmatch
import re
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import DAY_IN_NAME_RX


@dataclass(frozen=True)
class ListedFile:
    path: str
    name: str
    is_dir: bool
    size: int


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = _fs(spark, path)
    return bool(fs.exists(hpath))


def delete(spark: SparkSession, path: str) -> None:
    fs, hpath = _fs(spark, path)
    fs.delete(hpath, True)


def delete_at_end(spark: SparkSession, path: str) -> None:
    """Have a folder deleted when the session ends."""
    fs, hpath = _fs(spark, path)
    fs.deleteOnExit(hpath)


def create_exclusive(spark: SparkSession, path: str) -> bool:
    """Create an empty file in a folder that exists; False, and nothing done,
    where the name is taken. (Hadoop's local file system looks before it creates,
    which is not exclusive; Java's own call is.)"""
    fs, hpath = _fs(spark, path)
    if fs.getScheme() == "file":
        return bool(spark.sparkContext._jvm.java.io.File(hpath.toUri().getPath()).createNewFile())
    try:
        fs.create(hpath, False).close()
    except Py4JJavaError as e:
        if "AlreadyExists" in e.java_exception.getClass().getSimpleName():
            return False
        raise OSError(f"cannot create {path}") from e
    return True


def rename(spark: SparkSession, path: str, target: str) -> None:
    fs, hpath = _fs(spark, path)
    if not fs.rename(hpath, _fs(spark, target)[1]):
        raise OSError(f"cannot rename {path} to {target}")


def list_dir(spark: SparkSession, path: str, recursive: bool = False) -> list[ListedFile]:
    """Entries of a directory (files and directories), zero-length files
    included; ``recursive`` walks sub-directories and returns files only.
    A missing directory lists as empty."""
    fs, hpath = _fs(spark, path)
    if not fs.exists(hpath):
        return []
    out: list[ListedFile] = []
    if recursive:
        it = fs.listFiles(hpath, True)
        while it.hasNext():
            st = it.next()
            out.append(ListedFile(st.getPath().toString(), st.getPath().getName(), False, st.getLen()))
        return out
    for st in fs.listStatus(hpath):
        out.append(ListedFile(st.getPath().toString(), st.getPath().getName(), st.isDirectory(), st.getLen()))
    return out


def day_calendar(
    spark: SparkSession,
    path: str,
    glob: str = "user.application.*.csv",
    recursive: bool = False,
    pattern: str = DAY_IN_NAME_RX,
) -> DataFrame:
    """Distinct ``day`` of every file matching ``glob``, empty files included.

    Spark's file sources skip zero-length files, but an empty day file still
    counts as a day (it empties an every-day intersection), so the calendar
    comes from the listing. Names without a valid day are ignored. One row
    per file name: a listing, not data.
    """
    names = [f.name for f in list_dir(spark, path, recursive) if not f.is_dir and fnmatch.fnmatchcase(f.name, glob)]
    # Only the day text of each name enters the plan, once per day (48
    # half-hour files give one entry), as one literal array; Spark checks that
    # it is a real date.
    found = (re.search(pattern, n) for n in names)
    days = sorted({m.group(1) for m in found if m})
    literal = F.array(*[F.lit(d) for d in days]).cast("array<string>")
    listed = spark.range(1).select(F.explode(literal).alias("text"))
    return listed.select(F.col("text").try_cast("date").alias("day")).filter("day IS NOT NULL")
