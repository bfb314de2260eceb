import time

import pytest
from pyspark.sql import functions as F

from logloom.functions import (
    ancestors_and_self,
    ceil_mib,
    git_root,
    parse_int_text,
    parse_timestamp_text,
    period_start,
    period_text,
)
from logloom.functions.numbers import int_or_fail, wide_int_or_fail

# Expected values follow Python's datetime.strptime(x, "%Y-%m-%d %H:%M:%S").
TIMESTAMPS = [
    ("2025-01-01 00:00:01", "2025-01-01 00:00:01"),
    ("2025-1-1 1:2:3", "2025-01-01 01:02:03"),
    ("2025-01-01  00:00:00", "2025-01-01 00:00:00"),
    ("2025-01-01\t00:00:00", "2025-01-01 00:00:00"),
    ("2025-01- 1 00:00:00", "2025-01-01 00:00:00"),
    ("0001-01-01 00:00:00", "0001-01-01 00:00:00"),
    ("2024-02-29 23:59:59", "2024-02-29 23:59:59"),
    (" 2025-01-01 00:00:00", None),
    ("2025-01-01 00:00:00 ", None),
    ("2025-01-01 00:00:00.5", None),
    ("2025-01-01T00:00:00", None),
    ("2025-01-01", None),
    ("25-01-01 00:00:00", None),
    ("20250-01-01 00:00:00", None),
    ("2025-001-01 00:00:00", None),
    ("0000-01-01 00:00:00", None),
    ("2025-02-30 00:00:00", None),
    ("2023-02-29 00:00:00", None),
    ("2025-01-01 24:00:00", None),
    ("2025-01-01 00:00:60", None),
    ("2025-13-01 00:00:00", None),
    ("", None),
    ("2025-01-01 00:00:00\n", None),
]


def test_strict_timestamp_text(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(TIMESTAMPS)], "i int, t string")
    got = {
        r.i: r.p for r in df.select("i", parse_timestamp_text(F.col("t")).cast("string").alias("p")).collect()
    }
    for i, (text, expected) in enumerate(TIMESTAMPS):
        assert got[i] == expected, text


INTS = [
    ("5", 5), (" 5 ", 5), ("+5", 5), ("-3", -3), ("007", 7), ("1_000", 1000), ("1_000_000", 1000000),
    (" -1_0 ", -10), ("\t7\t", 7), ("5.0", None), ("x", None), ("", None), ("1__0", None), ("_1", None),
    ("1_", None), ("1,000", None), ("9223372036854775808", None), ("9223372036854775807", 9223372036854775807),
]


def test_int_text(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(INTS)], "i int, t string")
    got = {r.i: r.v for r in df.select("i", parse_int_text(F.col("t")).alias("v")).collect()}
    for i, (text, expected) in enumerate(INTS):
        assert got[i] == expected, text


def test_period_is_wall_clock_in_any_zone(spark):
    rows = [("2025-03-09 02:30:00",), ("2025-11-02 01:45:10",), ("1969-12-31 23:59:59",), ("0001-01-01 00:10:00",)]
    df = spark.createDataFrame(rows, "t string").select(F.col("t").cast("timestamp_ntz").alias("ts"))
    out = {}
    for zone in ("UTC", "America/New_York", "Asia/Kolkata"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        # window() allows one window expression per projection: two selects.
        half = df.select("ts", period_text(period_start(F.col("ts"), "30m")).alias("h"))
        both = half.select("h", period_text(period_start(F.col("ts"), "1day")).alias("d"))
        out[zone] = sorted(tuple(r) for r in both.collect())
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert out["UTC"] == out["America/New_York"] == out["Asia/Kolkata"]
    assert out["UTC"] == sorted([
        ("2025-03-09 02:30:00", "2025-03-09 00:00:00"),
        ("2025-11-02 01:30:00", "2025-11-02 00:00:00"),
        ("1969-12-31 23:30:00", "1969-12-31 00:00:00"),
        ("1-01-01 00:00:00", "1-01-01 00:00:00"),
    ])


def test_paths(spark):
    rows = [("/c/0/7/o1",), ("a/b",), ("/c/0/",), ("/x",)]
    df = spark.createDataFrame(rows, "p string")
    got = [r.a for r in df.select(ancestors_and_self(F.col("p")).alias("a")).collect()]
    assert got == [["/c", "/c/0", "/c/0/7", "/c/0/7/o1"], ["a", "a/b"], ["/c", "/c/0"], ["/x"]]
    roots = [r.r for r in spark.createDataFrame([("/a/.git",), ("/a/x.git",), ("/.git",), ("/a/.git/b",)], "p string")
             .select(git_root(F.col("p")).alias("r")).collect()]
    assert roots == ["/a", None, "/", None]


@pytest.mark.parametrize("n,mib", [(0, 0), (1, 1), (1 << 20, 1), ((1 << 20) + 1, 2), (1024 << 20, 1024), ((1024 << 20) + 1, 1025)])
def test_ceil_mib(spark, n, mib):
    assert spark.range(1).select(ceil_mib(F.lit(n).cast("bigint")).alias("m")).first().m == mib


def test_explode_ancestors_matches_array_form(spark):
    from logloom.functions import explode_ancestors

    rows = [("/c/0/7/o1", 1), ("a/b", 2), ("/c/0/", 3), ("/x", 4), ("/", 5)]
    df = spark.createDataFrame(rows, "p string, n int")
    exploded = sorted(tuple(r) for r in explode_ancestors(df, "p", "a", "n").collect())
    arrays = sorted((a, r.n) for r in df.select(ancestors_and_self(F.col("p")).alias("a"), "n").collect() for a in r.a)
    # the file-system root is above every absolute path
    assert exploded == sorted(arrays + [("/", 1), ("/", 3), ("/", 4)])


def test_parent_path(spark):
    from logloom.functions import parent_path

    rows = [("/a/b/f",), ("/f",), ("a/b",), ("a",), ("/a/b/",)]
    got = [r.p for r in spark.createDataFrame(rows, "x string").select(parent_path(F.col("x")).alias("p")).collect()]
    assert got == ["/a/b", "/", "a", "", "/a/b"]


def test_day_in_name(spark):
    from logloom.functions.paths import day_in_name

    names = ["user.application.2020-01-16-10-30.csv", "user.device.2020-01-16.csv", "2025-02-30.log.csv", "nodate.csv",
             "a.2020-1-16.csv"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r.d for r in df.select(day_in_name(F.col("n")).alias("d")).collect()]
    assert [str(d) if d else None for d in got] == ["2020-01-16", "2020-01-16", None, None, None]


@pytest.mark.parametrize("parse, tail", [(wide_int_or_fail, "0" * 18), (int_or_fail, "_000")])
def test_long_and_underscored_integers_cost_no_failing_casts(spark, parse, tail):
    def best(suffix: str) -> float:
        text = spark.range(0, 300_000, 1, 1).select(F.concat(F.col("id").cast("string"), F.lit(suffix)).alias("t"))
        text = text.select(*[F.concat(F.lit(str(i)), F.col("t")).alias(f"t{i}") for i in range(1, 4)])
        spent = []
        for _ in range(4):
            start = time.perf_counter()
            text.select(F.greatest(*[parse(F.col(c), c) for c in text.columns]).alias("m")).agg(F.max("m")).collect()
            spent.append(time.perf_counter() - start)
        return min(spent)

    # a cast that fails builds an exception: 15 to 30 times the time of one that does not
    assert best(tail) < 8 * best("")


def test_wide_integers_of_any_length_and_spelling(spark):
    taken = {"7": 7, " +7 ": 7, "1_000": 1000, "0" * 30 + "7": 7, " -" + "9" * 37 + "\n": -int("9" * 37), "1" * 18 + "_1": int("1" * 19),
             "123456789012345678": 123456789012345678, "1234567890123456789": 1234567890123456789}
    rows = spark.createDataFrame([(t,) for t in taken], "t string").select("t", wide_int_or_fail(F.col("t"), "m").cast("string").alias("n")).collect()
    assert {r.t: int(r.n) for r in rows} == taken
    for bad in ("1__0", "_1", "1.5", "1e3", "9" * 39, "1 2", "12345678901234567890.5", ""):
        with pytest.raises(Exception, match="38 digits in m"):
            spark.createDataFrame([(bad,)], "t string").select(wide_int_or_fail(F.col("t"), "m")).collect()
