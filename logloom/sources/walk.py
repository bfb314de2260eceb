"""Live directory trees as inventories (S10), listed in tasks.

``walk`` lists a tree in rounds: each task goes down from the directories it
was given until it has listed ``dirs_per_task`` of them (and holds no more names than that) and hands the rest to
the next round, which deals them evenly over tasks. So a small tree is one
round, a wide one spreads over the cluster after the first, and neither names
nor directories pass through the driver. Each round is written to the shared
checkpoint folder: a lost executor costs its own listing only.
"""

from __future__ import annotations

import os
import posixpath
import uuid
from collections import deque
from collections.abc import Callable, Iterator
from functools import reduce
from urllib.parse import urlparse

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import DAY_IN_NAME_RX
from ..session import checkpoint_dir
from .listing import delete_at_end

_ENTRIES = pa.schema([("path", pa.string()), ("kind", pa.string()), ("bytes", pa.int64()), ("unlisted", pa.binary())])
_DDL = "path string, kind string, bytes bigint, unlisted binary"
#: Rows that a listing task holds before it hands them on.
_BATCH = 10_000

#: path, whether it is a directory, bytes
Entry = tuple[bytes, bool, int]


def _local(folder: bytes) -> Iterator[Entry]:
    try:
        with os.scandir(folder) as entries:
            for e in entries:
                try:
                    yield e.path, e.is_dir(follow_symlinks=False), e.stat(follow_symlinks=False).st_size
                except FileNotFoundError:  # gone since it was listed
                    continue
    except (FileNotFoundError, NotADirectoryError, PermissionError):
        return


def _remote(root: str) -> Callable[[bytes], Iterator[Entry]]:
    from pyarrow import fs

    system, _ = fs.FileSystem.from_uri(root)

    def entries(folder: bytes) -> Iterator[Entry]:
        for e in system.get_file_info(fs.FileSelector(folder.decode(), allow_not_found=True)):
            yield e.path.encode(), e.type == fs.FileType.Directory, max(0, e.size or 0)

    return entries


def _is_local(root: str) -> bool:
    return urlparse(root).scheme in ("", "file")


def _list(root: str, dirs_per_task: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = _local if _is_local(root) else _remote(root)
        waiting: deque[bytes] = deque()
        rows: list[tuple] = []
        listed = 0

        def batch() -> pa.RecordBatch:
            out = pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), _ENTRIES)], schema=_ENTRIES)
            rows.clear()
            return out

        # a directory's own row goes out where it is found; one that is left to
        # the next round goes out once more, with only its raw name
        for given in batches:
            waiting.extend(given.column(0).to_pylist())
            while waiting:
                folder = waiting.popleft()
                if listed >= dirs_per_task:
                    rows.append((None, None, None, folder))
                else:
                    listed += 1
                    for path, is_dir, size in entries(folder):
                        rows.append((path.decode("utf-8", "replace"), "dir" if is_dir else "file", size, None))
                        if is_dir and len(waiting) < dirs_per_task - listed:
                            waiting.append(path)
                        elif is_dir:
                            rows.append((None, None, None, path))
                        if len(rows) >= _BATCH:
                            yield batch()
                if len(rows) >= _BATCH:
                    yield batch()
        if rows:
            yield batch()

    return run


def walk(spark: SparkSession, root: str, dirs_per_task: int = 1000) -> DataFrame:
    """``path, kind, bytes`` of everything under a directory, itself included,
    as ``read_inventory`` gives them: dot files, empty files and empty
    directories too.

    ``root`` is a path that all executors see (a plain path or ``file:``), or
    the URI of a file system that pyarrow knows (``hdfs:``, ``s3:``, ...). Paths
    begin with the root as it was given, without its scheme. As ``find`` and
    ``du --apparent-size`` do, symbolic links are files of their own length and
    are not followed; directories that vanish or may not be read list as empty. A
    file of several hard links counts at each. Names that are not UTF-8 show
    replacement characters. A root that is missing or no directory is an error.
    """
    if _is_local(root):
        start = posixpath.normpath(urlparse(root).path if root.startswith("file:") else root)
        if not os.path.isdir(start):
            raise ValueError(f"not a directory: {root}")
        size = os.stat(start).st_size
    else:
        from pyarrow import fs

        system, start = fs.FileSystem.from_uri(root)
        if system.get_file_info(start).type != fs.FileType.Directory:
            raise ValueError(f"not a directory: {root}")
        size = 0
    folder = f"{checkpoint_dir(spark)}/walk-{uuid.uuid4().hex}"
    delete_at_end(spark, folder)
    rounds = [spark.range(1).select(F.lit(start).alias("path"), F.lit("dir").alias("kind"), F.lit(size).cast("bigint").alias("bytes"))]
    todo = spark.range(1).select(F.lit(os.fsencode(start)).alias("unlisted"))
    left = 1
    while left:
        path = f"{folder}/round-{len(rounds)}"
        # AQE does not merge partitions of a stated number: a directory costs time, not bytes
        dealt = todo.repartition(min(10_000, -(-left // 16)))
        dealt.mapInArrow(_list(root, dirs_per_task), _DDL).write.parquet(path)
        found = spark.read.schema(_DDL).parquet(path)
        rounds.append(found.where("unlisted IS NULL").select("path", "kind", "bytes"))
        todo = found.where("unlisted IS NOT NULL").select("unlisted")
        left = todo.count()
    return reduce(DataFrame.unionAll, rounds)


def days_listed(entries: DataFrame, name_like: str = r"user\.application\..*\.csv", pattern: str = DAY_IN_NAME_RX) -> DataFrame:
    """Distinct ``day`` of the files of a listing (``path, kind``, as from
    ``walk``) whose whole name matches ``name_like``, empty files included:
    ``day_calendar`` for listings too large for the driver. Names without a real
    date are ignored."""
    name = F.regexp_extract("path", r"([^/]*)\z", 1)
    files = entries.where((F.col("kind") == "file") & name.rlike(rf"\A(?:{name_like})\z"))
    day = F.regexp_extract(name, pattern, 1).try_cast("date")
    return files.select(day.alias("day")).where("day IS NOT NULL").distinct()
