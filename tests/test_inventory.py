"""Repository sizes (P11, P12, J3, A6) against a brute-force prefix match."""

import pytest

from conftest import SF001

from logloom import repo_sizes
from logloom.plans import fixtures

MIB = 1 << 20


def brute(rows, min_mib):
    roots = {p[: -len("/.git")] or "/" for p, k, _ in rows if k == "dir" and p.endswith("/.git")}
    out = {}
    for r in roots:
        total = sum(b for p, _, b in rows if p == r or p.startswith(r.rstrip("/") + "/"))
        mib = -(-total // MIB)
        if mib > min_mib:
            out[r] = mib
    return out


def test_edge_cases(spark):
    rows = [
        ("/t/exact/.git", "dir", 0), ("/t/exact/big", "file", 1024 * MIB),            # 1024 MiB: out
        ("/t/plus/.git", "dir", 0), ("/t/plus/big", "file", 1024 * MIB + 1),           # 1025 MiB: in
        ("/t/gitfile/.git", "file", 0), ("/t/gitfile/big", "file", 2048 * MIB),        # .git file: no root
        ("/t/outer/.git", "dir", 4096), ("/t/outer/a", "file", 600 * MIB),
        ("/t/outer/inner/.git", "dir", 4096), ("/t/outer/inner/b", "file", 1000 * MIB),  # nested
        ("/t/outerish/c", "file", 5000 * MIB),                                          # not under /t/outer
    ]
    df = spark.createDataFrame(rows, "path string, kind string, bytes bigint")
    got = {r.root: r.size_mb for r in repo_sizes(df, 1024).collect()}
    assert got == {"/t/plus": 1025, "/t/outer": 1601}
    assert got == brute(rows, 1024)
    assert {r.root: r.size_mb for r in repo_sizes(df, 999).collect()} == brute(rows, 999)


def test_fixture_matches_brute_force(spark):
    inv = fixtures.inventory(spark, SF001)
    rows = [tuple(r) for r in inv.collect()]
    for threshold in (0, 100, 1024):
        got = {r.root: r.size_mb for r in repo_sizes(inv, threshold).collect()}
        assert got == brute(rows, threshold)


def test_trailing_slash_of_a_git_directory(spark):
    rows = [("/r/.git/", "dir", 1), ("/r/f", "file", 2 << 20), ("/s/x.git", "dir", 9)]
    got = repo_sizes(spark.createDataFrame(rows, "path string, kind string, bytes long"), 1)
    assert [tuple(r) for r in got.collect()] == [("/r", 3)]


def test_size_past_64_bits_stops_the_query(spark):
    rows = [("/r/.git", "dir", 1), ("/r/f", "file", 2**63 - 1)]
    df = spark.createDataFrame(rows, "path string, kind string, bytes long")
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            with pytest.raises(Exception, match="(?i)overflow"):
                repo_sizes(df, 1).collect()
        finally:
            spark.conf.set("spark.sql.ansi.enabled", "true")


def test_repository_at_the_file_system_root(spark):
    rows = [("/.git", "dir", 5), ("/f", "file", 2 << 20), ("/a/.git", "dir", 0), ("/a/g", "file", 3 << 20), ("/", "dir", 4096), ("rel/x", "file", 9 << 20), ("y", "file", 1)]
    got = {r.root: r.size_mb for r in repo_sizes(spark.createDataFrame(rows, "path string, kind string, bytes long"), 0).collect()}
    assert got == {"/": 6, "/a": 3}
