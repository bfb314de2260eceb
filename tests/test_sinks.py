"""Writers (K1–K4): names, sort order, dialect, empty results."""

import glob
import os

from conftest import SF001, write_files

from logloom import aggregate_logs, app_device_pairs, unique_users
from logloom.plans import fixtures
from logloom.sinks import next_result_name, write_result, write_summaries
from logloom.operators.usage import UNIQUE_USERS


def read_parts(path):
    parts = sorted(glob.glob(os.path.join(path, "part-*")))
    text = ""
    for p in parts:
        with open(p, newline="") as f:
            text += f.read()
    return text


def test_next_result_name(spark, tmp_path):
    d = str(tmp_path)
    assert next_result_name(spark, d) == "result.csv"
    write_files(tmp_path, {"result.csv": "", "result_3.csv": "", "result_x.csv": "", "other_9.csv": ""})
    assert next_result_name(spark, d) == "result_4.csv"
    assert next_result_name(spark, d, "other.csv") == "other.csv"
    write_files(tmp_path, {"out": ""})
    assert next_result_name(spark, d, "out") == "out_1.csv"


def test_write_result(spark, tmp_path):
    logs = fixtures.logs(spark, SF001)
    res = aggregate_logs(logs, "2024-01-01 00:00:00", "2024-01-03 00:00:00", "1day", "user,app")
    d = str(tmp_path)
    first = write_result(res, d)
    second = write_result(res, d)
    assert os.path.basename(first) == "result.csv" and os.path.basename(second) == "result_1.csv"
    text = read_parts(first)
    lines = text.split("\r\n")
    assert lines[0] == "timestamp,user,app," + ",".join(f"metric_{i}" for i in range(1, 10))
    assert lines[-1] == "" and "\n" not in text.replace("\r\n", "")
    body = [line.split(",") for line in lines[1:-1]]
    keys = [tuple(r[:3]) for r in body]
    assert keys == sorted(keys) and len(keys) == res.count()
    empty = aggregate_logs(logs, "2024-01-01 00:00:00", "2024-01-03 00:00:00", users="nobody")
    assert write_result(empty, d) is None
    assert sorted(os.listdir(d)) == ["result.csv", "result_1.csv"]


def test_write_result_quoting(spark, tmp_path):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(
        [("2024-01-01 10:00:00", 'us"er,5', "a"), ("2024-01-01 10:00:00", " sp ", "a"), ("2024-01-01 10:00:00", "", "a")],
        "t string, user string, app string",
    ).select(F.col("t").cast("timestamp_ntz").alias("ts"), "user", "app",
             *[F.lit(1).cast("bigint").alias(f"metric_{i}") for i in range(1, 10)])
    res = aggregate_logs(df, "2024-01-01 00:00:00", "2024-01-02 00:00:00", "1day", "user")
    lines = read_parts(write_result(res, str(tmp_path))).split("\r\n")[1:-1]
    ones = ",1" * 9
    assert lines == ["2024-01-01 00:00:00," + ones, "2024-01-01 00:00:00, sp " + ones,
                     '2024-01-01 00:00:00,"us""er,5"' + ones]


def test_write_summaries(spark, tmp_path):
    # As the exercise writes them: quoted header line, unquoted sorted rows, LF.
    ua = fixtures.user_app(spark, SF001)
    ud = fixtures.user_device(spark, SF001)
    out = write_summaries(ua, ud, str(tmp_path / "res"), day="2024-01-16")
    text = read_parts(out["apps_users.csv"])
    assert "\r" not in text
    apps = text.split("\n")
    assert apps[0] == '"application","number of unique users"'
    assert apps[1:-1] == sorted(apps[1:-1]) and apps[-1] == ""
    expected = {r["application"]: r[UNIQUE_USERS] for r in unique_users(ua, "application", "2024-01-16").collect()}
    assert dict((a, int(n)) for a, n in (line.split(",") for line in apps[1:-1])) == expected
    pairs = read_parts(out["apps_devices.csv"]).split("\n")
    assert pairs[0] == '"application","device"' and len(pairs) > 3
    assert pairs[1:-1] == sorted(pairs[1:-1])
    assert len(pairs) - 2 == app_device_pairs(ua, ud, "2024-01-16").count()
    # a day without rows: three header-only files, overwriting the previous run
    out = write_summaries(ua, ud, str(tmp_path / "res"), day="2030-01-01")
    assert read_parts(out["apps_users.csv"]) == '"application","number of unique users"\n'
    assert read_parts(out["devices_users.csv"]) == '"device","number of unique users"\n'
    assert read_parts(out["apps_devices.csv"]) == '"application","device"\n'


def test_write_summaries_raw_fields(spark, tmp_path):
    # Fields are written as the shell cuts them: quotes and spaces kept, no quoting.
    ua = spark.createDataFrame([("u1", 'a"b'), ("u2", '"q'), ("u1", " sp "), ("u3", "")], "user string, application string")
    ud = spark.createDataFrame([("u1", "d1"), ("u3", "d2")], "user string, device string")
    out = write_summaries(ua, ud, str(tmp_path / "res"))
    assert read_parts(out["apps_users.csv"]) == '"application","number of unique users"\n,1\n sp ,1\n"q,1\na"b,1\n'
    assert read_parts(out["apps_devices.csv"]) == '"application","device"\n,d2\n sp ,d1\na"b,d1\n'
