"""Log scan rules (S1–S6, P3, P4) on small literal day files."""

import pytest
from conftest import write_files
from pyspark.errors import PySparkException

from logloom import aggregate_logs, run_counts
from logloom.sinks import write_daily
from logloom.sources import read_logs

M = "1,2,3,4,5,6,7,8,9"


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_edge_rows(spark, tmp_path):
    text = "\r\n".join([
        f"2025-01-01 00:00:01,user1,facebook,{M}",            # kept
        f"2025-1-1 1:2:3,user1,facebook,{M}",                  # kept, unpadded
        f"2025-01-01  01:02:03,user1,facebook,{M}",            # kept, two spaces
        f"2025-01-01\t01:02:03,user1,facebook,{M}",            # kept, tab
        f" 2025-01-01 00:00:00,user1,facebook,{M}",            # dropped: outer space
        f"2025-01-01 00:00:00.5,user1,facebook,{M}",           # dropped: fraction
        f"2025-01-01T00:00:00,user1,facebook,{M}",             # dropped: T
        f"2025-01-01,user1,facebook,{M}",                      # dropped: date only
        f"2025-02-30 00:00:00,user1,facebook,{M}",             # dropped: no such day
        f"2025-01-01 24:00:00,user1,facebook,{M}",             # dropped: hour 24
        "2025-01-01 00:00:02,user1,facebook,1,2,3,4,5,6,7,8",  # dropped: 11 fields
        "",                                                    # dropped: blank
        f"2025-01-01 00:00:03,user1,facebook,{M},99",          # kept: 13 fields
        f"2025-01-01 00:00:04,,facebook,{M}",                  # kept: empty user
        f'2025-01-01 00:00:05,"us""er,5",facebook,{M}',        # kept: quoted user
        "2025-01-01 00:00:06,user1,facebook,1_000, 5 ,+5,-3,5,6,7,8,9",  # kept: int() forms
    ]) + "\r\n"
    d = write_files(tmp_path, {"2025-01-01.log.csv": text})
    logs = read_logs(spark, d)
    got = rows(logs, "timestamp", "user")
    assert [r[0] for r in got] == sorted([
        "2025-01-01 00:00:01", "2025-1-1 1:2:3", "2025-01-01  01:02:03", "2025-01-01\t01:02:03",
        "2025-01-01 00:00:03", "2025-01-01 00:00:04", "2025-01-01 00:00:05", "2025-01-01 00:00:06",
    ])
    assert ('2025-01-01 00:00:05', 'us"er,5') in got
    agg = aggregate_logs(logs, "2025-01-01 00:00:00", "2025-01-02 00:00:00", "1day", "user")
    by_user = {r.user: r for r in agg.collect()}
    assert set(by_user) == {"user1", "", 'us"er,5'}
    u1 = by_user["user1"]
    # five rows of M, plus the int() forms row
    assert (u1.metric_1, u1.metric_2, u1.metric_3, u1.metric_4) == (5 * 1 + 1000, 5 * 2 + 5, 5 * 3 + 5, 5 * 4 - 3)
    assert by_user[""].metric_9 == 9


def test_day_files_prune_and_both_bounds(spark, tmp_path):
    d = write_files(tmp_path, {
        "2025-01-01.log.csv": f"2025-01-01 10:00:00,u,a,{M}\n",
        # a row dated 01-01 inside the 01-02 file, and a 01-02 row
        "2025-01-02.log.csv": f"2025-01-01 23:00:00,u,a,{M}\n2025-01-02 01:00:00,u,a,{M}\n",
        "2025-01-03.log.csv": f"2025-01-03 01:00:00,u,a,{M}\n",
        "notes.csv": "garbage\n",
        "2025-01-09.txt": "garbage\n",
    })
    logs = read_logs(spark, d)
    # range 01-01 12:00 .. 01-02 00:30: file days 01-01 and 01-02 are read;
    # the 01-01 23:00 row in the 01-02 file is in range on both counts.
    agg = aggregate_logs(logs, "2025-01-01 12:00:00", "2025-01-02 00:30:00", "1day", "user")
    assert rows(agg, "timestamp", "metric_1") == [("2025-01-01 00:00:00", 1)]
    # range starting on 01-02 excludes the 01-01 row of the 01-02 file by ts
    agg = aggregate_logs(logs, "2025-01-02 00:00:00", "2025-01-05 00:00:00", "1day", "user")
    assert rows(agg, "timestamp", "metric_1") == [("2025-01-02 00:00:00", 1), ("2025-01-03 00:00:00", 1)]
    # only the 01-01 file by day: the 01-01 23:00 row in the 01-02 file is out
    agg = aggregate_logs(logs, "2025-01-01 00:00:00", "2025-01-01 23:59:59", "1day", "user")
    assert rows(agg, "timestamp", "metric_1") == [("2025-01-01 00:00:00", 1)]
    # missing day files are fine; range bounds: from kept, to dropped
    agg = aggregate_logs(logs, "2025-01-01 10:00:00", "2025-01-03 01:00:00", "30m", "user")
    assert rows(agg, "timestamp") == [("2025-01-01 10:00:00",), ("2025-01-01 23:00:00",), ("2025-01-02 01:00:00",)]


def test_pruned_read_counts_files(spark, tmp_path):
    d = write_files(tmp_path, {f"2025-01-0{i}.log.csv": f"2025-01-0{i} 10:00:00,u,a,{M}\n" for i in range(1, 6)})
    d = write_files(tmp_path, {"2025-01-04.log.csv": ""})
    logs = read_logs(spark, d, "2025-01-02 00:00:00", "2025-01-04 12:00:00")
    df = logs.select("file_date")
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    scans = []

    def walk(p):
        if "Scan" in p.nodeName():
            scans.append(p.metrics().apply("numFiles").value())
        for i in range(p.children().size()):
            walk(p.children().apply(i))

    walk(plan)
    # days 02..04 of 01..05 pass the name filter; Spark skips the empty 04 file
    assert scans == [2]


@pytest.mark.parametrize("layout", ["flat", "daily"])
def test_range_of_the_query_alone_prunes_files(spark, tmp_path, layout):
    name = "2025-01-{:02}.log.csv" if layout == "flat" else "file_date=2025-01-{:02}/part.csv"
    d = write_files(tmp_path, {name.format(i): f"2025-01-{i:02} 10:00:00,u,a,{M}\n" for i in range(1, 11)})
    df = aggregate_logs(read_logs(spark, d), "2025-01-04 00:00:00", "2025-01-05 12:00:00")
    assert df.count() == 2
    df.collect()
    plan, found = df._jdf.queryExecution().executedPlan(), []

    def walk(p):
        name = p.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            return walk(p.executedPlan())
        if "QueryStage" in name:
            return walk(p.plan())
        if "Scan" in name:
            found.append(p.metrics().apply("numFiles").value())
        for i in range(p.children().size()):
            walk(p.children().apply(i))

    walk(plan)
    assert found == [2]


def test_bad_metric_fails_only_when_matching(spark, tmp_path):
    d = write_files(tmp_path, {
        "2025-01-01.log.csv": f"2025-01-01 10:00:00,u1,a,{M}\n2025-01-01 11:00:00,u2,a,1,2,3,4,5,6,7,8,x\n",
    })
    logs = read_logs(spark, d)
    ok = aggregate_logs(logs, "2025-01-01 00:00:00", "2025-01-02 00:00:00", "1day", "user", users="u1")
    assert ok.count() == 1
    for bad in ("x", "5.0", ""):
        d2 = write_files(tmp_path / bad.replace(".", "_") if bad else tmp_path / "empty",
                         {"2025-01-01.log.csv": f"2025-01-01 11:00:00,u2,a,1,2,3,4,5,6,7,8,{bad}\n"})
        with pytest.raises(PySparkException, match="invalid literal for int"):
            aggregate_logs(read_logs(spark, d2), "2025-01-01 00:00:00", "2025-01-02 00:00:00").collect()


def test_run_counts_fail_on_a_bad_metric_like_the_sums(spark, tmp_path):
    # The script stops on int('x') in a matching row before printing counts.
    d = write_files(tmp_path, {"2025-01-01.log.csv": (
        f"2025-01-01 10:00:00,u1,a,{M}\n2025-01-01 11:00:00,u2,a,1,2,3,4,5,6,7,8,x\n"
    )})
    args = ("2025-01-01 00:00:00", "2025-01-02 00:00:00", "1day", "user")
    assert tuple(run_counts(read_logs(spark, d), *args, users="u1").first()) == (1, 1, 1)
    with pytest.raises(PySparkException, match="invalid literal for int"):
        run_counts(read_logs(spark, d), *args).collect()


def test_long_row_with_empty_last_metric_is_kept(spark, tmp_path):
    # 13 fields with the 12th empty: Python's reader keeps the row (12 or
    # more fields), so int('') stops a query that matches it. Spark flags the
    # row as malformed (too many fields) and reads the empty field as null;
    # counting the raw line's fields tells it from a short row.
    d = write_files(tmp_path, {"2025-01-01.log.csv": (
        f"2025-01-01 10:00:00,u1,a,{M}\n"
        "2025-01-01 11:00:00,u2,a,1,2,3,4,5,6,7,8,,extra\n"
        '2025-01-01 11:00:00,u3,"a,b",1,2,3,4,5,6,7,8\n'  # 11 fields, a comma inside quotes: short
    )})
    logs = read_logs(spark, d)
    assert sorted(r.user for r in logs.collect()) == ["u1", "u2"]
    args = ("2025-01-01 00:00:00", "2025-01-02 00:00:00", "1day", "user")
    assert aggregate_logs(logs, *args, users="u1").count() == 1
    with pytest.raises(PySparkException, match="invalid literal for int"):
        aggregate_logs(logs, *args, users="u2").collect()


def test_newline_in_quotes(spark, tmp_path):
    d = write_files(tmp_path, {"2025-01-01.log.csv": f'2025-01-01 10:00:00,"u\nx",a,{M}\n2025-01-01 10:00:01,u,a,{M}\n'})
    assert sorted(r.user for r in read_logs(spark, d).collect()) == ["u", "u\nx"]


def test_daily_layout_round_trip(spark, tmp_path):
    from logloom.plans import fixtures

    logs = fixtures.logs(spark, "/root/testdata/sf0.001")
    out = str(tmp_path / "daily")
    write_daily(logs, out)
    back = read_logs(spark, out)
    assert back.count() == logs.count()
    args = ("2024-01-02 06:00:00", "2024-01-09 12:00:00", "30m", "user,app")
    assert rows(aggregate_logs(back, *args), "*") == rows(aggregate_logs(logs, *args), "*")
    # each part file is sorted by user, rows keep whole-second text
    import glob
    import os

    parts = glob.glob(os.path.join(out, "file_date=*", "*.csv"))
    assert parts and all(os.path.basename(os.path.dirname(p)).startswith("file_date=2024-") for p in parts)
    for p in parts:
        with open(p, newline="") as f:
            lines = f.read().split("\r\n")[:-1]
        users = [line.split(",")[1] for line in lines]
        assert users == sorted(users)
        assert all(len(line.split(",")[0]) == 19 for line in lines)


def test_run_counts_with_listing(spark, tmp_path):
    from logloom.sources import day_calendar

    d = write_files(tmp_path, {
        "2025-01-01.log.csv": f"2025-01-01 10:00:00,u1,a,{M}\n2025-01-01 10:10:00,u1,a,{M}\n2025-01-01 11:00:00,u2,b,{M}\n",
        "2025-01-02.log.csv": "",
        "2025-01-03.log.csv": f"2025-01-03 10:00:00,u1,a,{M}\n",
    })
    logs = read_logs(spark, d)
    files = day_calendar(spark, d, glob="*.log.csv")
    rc = run_counts(logs, "2025-01-01 00:00:00", "2025-01-02 23:00:00", "1day", "user", apps="a", files=files)
    assert tuple(rc.first()) == (2, 2, 1)
    rc = run_counts(logs, "2025-01-01 00:00:00", "2025-01-02 23:00:00", "1day", "user", apps="a")
    assert tuple(rc.first()) == (1, 2, 1)


def test_flat_layout_reads_only_the_directory_itself(spark, tmp_path):
    # The script opens <dir>/<day>.log.csv only; a day file in a
    # sub-directory is not read.
    d = write_files(tmp_path, {
        "2025-01-01.log.csv": f"2025-01-01 10:00:00,top,fb,{M}\n",
        "sub/2025-01-01.log.csv": f"2025-01-01 10:00:00,nested,fb,{M}\n",
    })
    assert [r.user for r in read_logs(spark, d).collect()] == ["top"]
