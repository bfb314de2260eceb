"""The streaming aggregation equals the batch one once the watermark has
passed every bucket, in any caller session zone."""

import os
import shutil

import pytest
from conftest import SF001

from logloom import aggregate_logs
from logloom.plans import fixtures
from logloom.sinks import write_daily
from logloom.sources import read_logs
from logloom.streaming import aggregate_logs_stream, stream_logs

ARGS = ("2024-01-02 06:00:00", "2024-12-31 00:00:00", "30m", "user,app")
FLUSH = "2024-06-01"  # buckets before this day are closed by the flush rows


@pytest.fixture(scope="module")
def day_files(spark, tmp_path_factory):
    """sf0.001 logs as flat ``YYYY-MM-DD.log.csv`` files (one per day)."""
    root = tmp_path_factory.mktemp("stream")
    daily = str(root / "daily")
    write_daily(fixtures.logs(spark, SF001), daily)
    flat = root / "flat"
    flat.mkdir()
    for d in sorted(os.listdir(daily)):
        if d.startswith("file_date="):
            with open(flat / f"{d.split('=')[1]}.log.csv", "w", newline="") as out:
                for part in sorted(os.listdir(os.path.join(daily, d))):
                    if part.endswith(".csv"):
                        with open(os.path.join(daily, d, part), newline="") as f:
                            out.write(f.read())
    return str(flat)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_stream_equals_batch(spark, day_files, tmp_path, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        src = tmp_path / "in"
        src.mkdir()
        stream = aggregate_logs_stream(stream_logs(spark, str(src), max_files_per_trigger=5), *ARGS, lateness="31 days")
        q = (
            stream.writeStream.outputMode("append").format("memory").queryName(f"agg_{zone.replace('/', '_')}")
            .option("checkpointLocation", str(tmp_path / "ck")).start()
        )
        for name in sorted(os.listdir(day_files)):
            shutil.copy(os.path.join(day_files, name), src / name)
        q.processAllAvailable()
        # rows months later move the watermark past every bucket of January
        for day in ("2024-06-01", "2024-06-02"):
            with open(src / f"{day}.log.csv", "w") as f:
                f.write(f"{day} 00:00:00,flush,flush,1,1,1,1,1,1,1,1,1\n")
            q.processAllAvailable()
        # the memory sink registers its table in the stream's own session
        got = sorted(tuple(r) for r in stream.sparkSession.sql(f"SELECT * FROM {q.name}").collect())
        q.stop()
        batch = aggregate_logs(read_logs(spark, day_files), *ARGS)
        assert got == sorted(tuple(r) for r in batch.collect() if r.timestamp < FLUSH)
        assert len(got) > 100
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_stream_resumes_from_its_checkpoint(spark, day_files, tmp_path):
    # A query stopped halfway and restarted on the same checkpoint writes
    # every bucket exactly once: the file sink's commit log and the state
    # store carry over, as they would after a lost driver or executor.
    from logloom.streaming import start_csv_stream

    src, out, ck = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ck")
    src.mkdir()
    names = sorted(os.listdir(day_files))
    half = len(names) // 2

    def run(files, flush=()):
        stream = aggregate_logs_stream(stream_logs(spark, str(src), max_files_per_trigger=4), *ARGS, lateness="31 days")
        q = start_csv_stream(stream, out, "resume", checkpoint=ck)
        for name in files:
            shutil.copy(os.path.join(day_files, name), src / name)
        q.processAllAvailable()
        for day in flush:
            with open(src / f"{day}.log.csv", "w") as f:
                f.write(f"{day} 00:00:00,flush,flush,1,1,1,1,1,1,1,1,1\n")
            q.processAllAvailable()
        q.stop()

    run(names[:half])
    run(names[half:], flush=("2024-06-01", "2024-06-02"))
    schema = "timestamp string, user string, app string, " + ", ".join(f"metric_{i} bigint" for i in range(1, 10))
    got = sorted(tuple(r) for r in spark.read.schema(schema).option("header", True).csv(out).collect())
    batch = aggregate_logs(read_logs(spark, day_files), *ARGS)
    assert got == sorted(tuple(r) for r in batch.collect() if r.timestamp < FLUSH)
