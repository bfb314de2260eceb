"""The quote-exact scan against csv.reader, on files cut into many splits."""

import csv
import io
import random

import pytest
from conftest import write_files

from logloom.sources import read_logs
from logloom.sources.quoted import left_open

M = "1,2,3,4,5,6,7,8,9"


def _expected(texts):
    rows = []
    for name, text in texts.items():
        rows += [tuple(r[:12]) for r in csv.reader(io.StringIO(text, newline="")) if len(r) >= 12 and r[0].startswith("2025-01-01 ")]
    return sorted(rows)


def _got(df):
    return sorted(tuple("" if r[c] is None else r[c] for c in ("timestamp", "user", "app", *[f"metric_{i}" for i in range(1, 10)])) for r in df.collect())


@pytest.fixture()
def small_splits(spark):
    keep = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield spark
    for k, v in keep.items():
        spark.conf.set(k, v)


def _field(rng):
    kind = rng.random()
    body = "".join(rng.choice(["a", "b", ",", "\n", "\r\n", " ", "é", '""', "x" * 30]) for _ in range(rng.randint(0, 6)))
    if kind < 0.55:
        return rng.choice(["u1", "", 'a"b', "plain"])
    if kind < 0.9:
        return f'"{body}"'
    if kind < 0.97:
        return f'"{body}"tail"s'  # text after the closing quote belongs to the field
    return f'"{body * 40}"'


@pytest.mark.parametrize("seed", range(4))
def test_random_files_in_small_splits(small_splits, tmp_path, seed):
    rng = random.Random(seed)
    texts = {}
    for day in ("2025-01-01", "2025-01-02", "2025-01-03"):
        rows = []
        for _ in range(60):
            fields = ["2025-01-01 10:00:00", _field(rng), _field(rng), *M.split(",")][: rng.choice([12, 12, 12, 11])] + ["more"] * rng.choice([0, 0, 2])
            rows.append(",".join(fields) + rng.choice(["\n", "\r\n"]))
        # sometimes a quote that nothing closes
        texts[f"{day}.log.csv"] = "".join(rows) + (f'2025-01-01 10:00:00,"open,x,{M}\n' + "".join(rows[:9]).replace('"', "") if rng.random() < 0.5 else "")
    d = write_files(tmp_path, texts)
    df = read_logs(small_splits, d)
    assert _got(df) == _expected(texts)


def test_megabytes_with_a_field_over_many_splits(spark, tmp_path):
    keep = spark.conf.get("spark.sql.files.maxPartitionBytes")
    rows = [f'2025-01-01 10:00:00,"user ""{i % 7}""\nx",app{i % 3},{M}\n' for i in range(30_000)]
    rows[15_000] = '2025-01-01 10:00:00,"' + 'a line of it, with "" quotes\n' * 60_000 + f'",app,{M}\n'
    text = "".join(rows)
    d = write_files(tmp_path, {"2025-01-01.log.csv": text, "2025-01-02.log.csv": f"2025-01-02 10:00:00,plain,a,{M}\n" * 10})
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        df = read_logs(spark, d)
        assert len(text) > 3_000_000 and df.rdd.getNumPartitions() > 15
        got = {(r.user, r.app): r["count"] for r in df.groupBy("user", "app").count().collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", keep)
    want = {}
    csv.field_size_limit(10**9)  # past it the script stops with an error
    for r in csv.reader(io.StringIO(text, newline="")):
        want[r[1], r[2]] = want.get((r[1], r[2]), 0) + 1
    want["plain", "a"] = 10
    assert got == want


def test_text_after_a_closing_quote_and_unclosed_quotes(spark, tmp_path):
    text = f'2025-01-01 10:00:00,"ab"c,a,{M}\n2025-01-01 10:00:00,"""q""",a,{M}\n2025-01-01 10:00:00,u,"open,{M}\n2025-01-01 10:00:00,v,a,{M}\n'
    assert [r[1] for r in _got(read_logs(spark, write_files(tmp_path, {"2025-01-01.log.csv": text})))] == ['"q"', "abc"]


def test_files_without_quotes_take_the_csv_reader(spark, tmp_path):
    d = write_files(tmp_path, {"2025-01-01.log.csv": f"2025-01-01 10:00:00,u,a,{M}\n", "2025-01-02.log.csv": f'2025-01-01 10:00:00,"u\nx",a,{M}\n'})
    plain = read_logs(spark, d, "2025-01-01 00:00:00", "2025-01-01 12:00:00")
    assert "MapInArrow" not in plain._jdf.queryExecution().executedPlan().toString()
    assert _got(read_logs(spark, d)) == sorted([("2025-01-01 10:00:00", u, "a", *M.split(",")) for u in ("u", "u\nx")])
    assert [r.user for r in read_logs(spark, d, quotes="none").collect()] == ["u"]
    with pytest.raises(ValueError, match="quotes must be"):
        read_logs(spark, d, quotes="some")


def test_daily_layout_with_quotes(spark, tmp_path):
    d = write_files(tmp_path, {f"file_date=2025-01-0{i}/part.csv": f'2025-01-01 10:00:00,"u{i}\nx",a,{M}\n' for i in (1, 2, 3)})
    assert [(str(r.file_date), r.user) for r in read_logs(spark, d, "2025-01-02 00:00:00", "2025-01-03 00:00:00").orderBy("file_date").collect()] == [
        ("2025-01-02", "u2\nx"), ("2025-01-03", "u3\nx")]


def test_two_layouts_in_one_directory_are_an_error(spark, tmp_path):
    row = f"2025-01-01 10:00:00,u,a,{M}\n"
    d = write_files(tmp_path, {"2025-01-01.log.csv": row, "file_date=2025-01-02/part.csv": row})
    for layout in ("auto", "flat", "daily"):
        with pytest.raises(ValueError, match="both layouts"):
            read_logs(spark, d, layout=layout)


@pytest.mark.parametrize("line, outside, inside", [
    ("a,b", False, True), ('a,"b', True, False), ('"a""', True, False), ('a"b', False, False), ('"a"b"c,d', False, False), ('","', False, True), ("", False, True),
    ('""', False, True), ('"""', True, False), ('x\r"y', True, False)])
def test_states_of_lines(line, outside, inside):
    assert (left_open(line, False), left_open(line, True)) == (outside, inside)
