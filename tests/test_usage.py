"""Pair files and the usage operators."""

import datetime
import glob
import os

import pytest
from conftest import write_files

from logloom import UNIQUE_USERS, app_device_pairs, everyday_users, unique_users
from logloom.sources import day_calendar, read_daily_pairs, read_pairs


def as_set(df):
    return {tuple(r) for r in df.collect()}


@pytest.fixture()
def half_hour(tmp_path):
    return write_files(tmp_path, {
        "user.application.2020-01-16-00-00.csv": "u1,app1\nu2,app1\nu1,app2\n",
        "sub/user.application.2020-01-16-00-30.csv": "u1,app1\nu3,app2\n\"u4,app3\nnocomma\nu5,\nu6,app1,extra\n",
        "user.application.2020-01-17-00-00.csv": "u9,app9\n",
        "user.device.2020-01-16-00-00.csv": "u1,dev1\nu2,dev2\n",
        "sub/deeper/user.device.2020-01-16-23-30.csv": "u1,dev1\nu3,dev1\nu7,dev3\n",
    })


def test_pair_scan(spark, half_hour):
    ua = read_pairs(spark, half_hour, "application", day="2020-01-16")
    assert as_set(ua.select("user", "application")) == {
        ("u1", "app1"), ("u2", "app1"), ("u1", "app2"), ("u3", "app2"), ('"u4', "app3"), ("u5", ""), ("u6", "app1"),
    }
    assert {r.day.isoformat() for r in ua.collect()} == {"2020-01-16"}


def test_unique_users_and_pairs(spark, half_hour):
    ua = read_pairs(spark, half_hour, "application", day="2020-01-16")
    ud = read_pairs(spark, half_hour, "device", day="2020-01-16")
    assert unique_users(ua, "application").columns == ["application", UNIQUE_USERS]
    assert as_set(unique_users(ua, "application")) == {("app1", 3), ("app2", 2), ("app3", 1), ("", 1)}
    assert as_set(unique_users(ud, "device")) == {("dev1", 2), ("dev2", 1), ("dev3", 1)}
    # u1: app1, app2 x dev1; u2: app1 x dev2; u3: app2 x dev1; u4-u6 have no device; u7 no app
    assert as_set(app_device_pairs(ua, ud)) == {("app1", "dev1"), ("app2", "dev1"), ("app1", "dev2")}


def test_pair_line_with_empty_key_and_extra_field(spark, tmp_path):
    # cut -d, -f2 gives '' for "u1,,x"; a line without a comma has no key.
    d = write_files(tmp_path, {"user.application.2020-01-16-00-00.csv": "u1,,x\nu2\nu3,app1,y\n"})
    ua = read_pairs(spark, d, "application", day="2020-01-16")
    assert as_set(ua.select("user", "application")) == {("u1", ""), ("u3", "app1")}


def test_no_pair_files(spark, tmp_path):
    ua = read_pairs(spark, str(tmp_path), "application", day="2020-01-16")
    assert ua.count() == 0 and unique_users(ua, "application").count() == 0


@pytest.fixture()
def daily(tmp_path):
    return write_files(tmp_path, {
        "user.application.2020-01-16.csv": "u1,app1\nu2,app1\nu3,app1\nu3,app2\n",
        "user.application.2020-01-17.csv": "u1,app1\nu2,app1\nu3,app2\n",
        "user.application.2020-01-18.csv": "u1,app1\nu2,app2\n",
        "user.application.2020-01-19.csv": "",
        "user.application.2020-01-20.csv": "u1,app1\n",
        "sub/user.application.2020-01-15.csv": "u9,app1\n",
    })


def test_everyday_users(spark, daily):
    ua = read_daily_pairs(spark, daily)
    cal = day_calendar(spark, daily)
    users = lambda d, app="app1": sorted(r.user for r in everyday_users(ua, d, app, calendar=cal).collect())
    assert users("2020-01-16") == ["u1", "u2", "u3"]
    assert users("2020-01-17") == ["u1", "u2"]
    assert users("2020-01-18") == ["u1"]
    assert users("2020-01-19") == []  # the empty day file counts as a day
    assert users("2020-01-30") == []
    assert users("2020-01-17", "app2") == ["u3"]
    assert users("2020-01-17", "nope") == []
    # without a listing the empty day is unknown
    assert sorted(r.user for r in everyday_users(ua, "2020-01-19", "app1").collect()) == ["u1"]
    with pytest.raises(ValueError, match="No files found"):
        everyday_users(ua, "2020-01-01", "app1", calendar=cal)


def test_everyday_users_planted_streak(spark, tmp_path):
    # The exercise's mock shape: 7 daily files, user1 and user2 on app1 each
    # day, 20 noise rows per day (fixed here). Expected: the exercise's loop,
    # a repeated intersection of each day's users of the app.
    days = [f"2020-01-{d}" for d in range(16, 23)]
    files, per_day = {}, {}
    for i, day in enumerate(days):
        rows = [("user1", "app1"), ("user2", "app1")]
        rows += [(f"user{(7 * i + 3 * j) % 100 + 1}", f"app{(i + j) % 20 + 1}") for j in range(20)]
        files[f"user.application.{day}.csv"] = "".join(f"{u},{a}\n" for u, a in rows)
        per_day[day] = rows
    d = write_files(tmp_path, files)
    ua = read_daily_pairs(spark, d)
    cal = day_calendar(spark, d)
    for app in ("app1", "app2", "app7"):
        candidates = None
        for day in days:
            today = {u for u, a in per_day[day] if a == app}
            candidates = today if candidates is None else candidates & today
            got = sorted(r.user for r in everyday_users(ua, day, app, calendar=cal).collect())
            assert got == sorted(candidates), (app, day)
    assert sorted(r.user for r in everyday_users(ua, "2020-01-22", "app1", calendar=cal).collect()) == ["user1", "user2"]


def test_summaries_on_the_half_hour_mock_shape(spark, tmp_path):
    # The exercise's mock shape: 48 half-hour files per kind for one day, 5-20
    # rows each (fixed here), spread over sub-directories, plus another day's
    # file that must be left out. Expected: the shell pipeline, written out.
    from logloom.sinks import write_summaries

    files, app_lines, dev_lines = {}, set(), set()
    for i in range(48):
        stamp = f"2020-01-16-{i // 2:02d}-{30 * (i % 2):02d}"
        sub = f"part{i % 3}/" if i % 4 else ""
        apps = [f"user{(11 * i + 7 * j) % 100 + 1},app{(i * j + 3) % 20 + 1}" for j in range(5 + i % 16)]
        devs = [f"user{(13 * i + 5 * j) % 100 + 1},device{(i + 2 * j) % 50 + 1}" for j in range(5 + (i * 7) % 16)]
        files[f"{sub}user.application.{stamp}.csv"] = "".join(f"{line}\n" for line in apps)
        files[f"{sub}user.device.{stamp}.csv"] = "".join(f"{line}\n" for line in devs)
        app_lines |= set(apps)
        dev_lines |= set(devs)
    files["user.application.2020-01-17-00-00.csv"] = "user1,app99\n"
    d = write_files(tmp_path / "in", files)

    def counts(lines):  # sort -u | cut -d, -f2 | sort | uniq -c | awk '{print $2 "," $1}'
        keys = [line.split(",")[1] for line in lines]
        return "".join(f"{k},{keys.count(k)}\n" for k in sorted(set(keys)))

    pairs = {(a.split(",")[1], v.split(",")[1]) for a in app_lines for v in dev_lines if a.split(",")[0] == v.split(",")[0]}
    expected = {
        "apps_users.csv": '"application","number of unique users"\n' + counts(app_lines),
        "devices_users.csv": '"device","number of unique users"\n' + counts(dev_lines),
        "apps_devices.csv": '"application","device"\n' + "".join(f"{a},{v}\n" for a, v in sorted(pairs)),
    }
    ua = read_pairs(spark, d, "application", day="2020-01-16")
    ud = read_pairs(spark, d, "device", day="2020-01-16")
    out = write_summaries(ua, ud, str(tmp_path / "results"))
    for name, text in expected.items():
        parts = sorted(glob.glob(os.path.join(out[name], "part-*")))
        got = "".join(open(p, newline="").read() for p in parts)
        assert got == text, name


def test_everyday_counts_only_calendar_days(spark):
    """Rows on a day that the calendar lacks do not stand in for a listed day."""
    day = datetime.date
    pairs = [("u1", "a", day(2024, 1, 16)), ("u1", "a", day(2024, 1, 18)), ("u2", "a", day(2024, 1, 16)), ("u2", "a", day(2024, 1, 17)),
             ("u2", "a", day(2024, 1, 18))]
    user_app = spark.createDataFrame(pairs, "user string, application string, day date")
    calendar = spark.createDataFrame([(day(2024, 1, 16),), (day(2024, 1, 17),)], "day date")
    assert [r["user"] for r in everyday_users(user_app, "2024-01-18", "a", calendar).collect()] == ["u2"]
