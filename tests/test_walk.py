"""Live directory walks against Python's own, and results claimed by two writers."""

from __future__ import annotations

import os
import re
import threading

import pytest
from conftest import SF001, write_files

from logloom import aggregate_logs, repo_sizes
from logloom.cli import main
from logloom.plans import fixtures
from logloom.sinks import write_result
from logloom.sources import day_calendar, days_listed, walk

MIB = 1 << 20


def _sparse(path, size):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.truncate(size)


@pytest.fixture()
def tree(tmp_path):
    root = str(tmp_path / "tree")
    for n in range(7):
        for m in range(5):
            _sparse(f"{root}/d{n}/e{m}/.hidden/f", n * MIB + m)
            _sparse(f"{root}/d{n}/e{m}/empty", 0)
        if n % 2:
            os.makedirs(f"{root}/d{n}/.git/objects")
            _sparse(f"{root}/d{n}/.git/objects/pack", MIB)
    os.makedirs(f"{root}/d0/e0/.git")
    _sparse(f"{root}/d2/.git", 5)  # a file: no repository
    os.makedirs(f"{root}/d4/no files, é/.git")
    deep = f"{root}/" + "/".join("x" * 3 for _ in range(30))
    _sparse(f"{deep}/f", 3)
    os.symlink(root, f"{root}/d1/loop")
    os.symlink("nowhere", f"{root}/d1/dangling")
    return root


def _python_walk(root):
    yield root, "dir", os.stat(root).st_size
    for folder, dirs, files in os.walk(root):
        for name in dirs + files:
            path = os.path.join(folder, name)
            is_dir = os.path.isdir(path) and not os.path.islink(path)
            yield path, "dir" if is_dir else "file", os.lstat(path).st_size


@pytest.mark.parametrize("dirs_per_task", [1, 4, 1000])
def test_walk_equals_python(spark, tree, dirs_per_task):
    got = [tuple(r) for r in walk(spark, tree, dirs_per_task).collect()]
    assert sorted(got) == sorted(_python_walk(tree))


def test_file_uri_and_trailing_slash(spark, tree):
    want = sorted(_python_walk(f"{tree}/d1"))
    for root in (f"file://{tree}/d1", f"{tree}/d1/"):
        assert sorted(tuple(r) for r in walk(spark, root).collect()) == want


def test_repositories_of_a_live_tree(spark, tree, capsys):
    rows = list(_python_walk(tree))
    want = {}
    for path, kind, _ in rows:
        if kind == "dir" and path.endswith("/.git"):
            repo = os.path.dirname(path)
            size = -(-sum(b for p, _, b in rows if p == repo or p.startswith(repo + "/")) // MIB)
            if size > 4:
                want[repo] = size
    assert len(want) >= 3
    assert {r.root: r.size_mb for r in repo_sizes(walk(spark, tree, 3), 4).collect()} == want
    assert main(["repo-sizes", tree, "--format", "tree", "--min-mib", "4"]) == 0
    out = capsys.readouterr().out
    assert dict(zip(re.findall(r"Found: (.*)", out), map(int, re.findall(r"Size: (\d+) MB", out)))) == want


def test_roots_that_are_no_directory(spark, tree, tmp_path):
    os.makedirs(tmp_path / "none")
    assert [r.kind for r in walk(spark, str(tmp_path / "none")).collect()] == ["dir"]
    for root in (f"{tree}/missing", f"{tree}/d2/.git"):
        with pytest.raises(ValueError, match="not a directory"):
            walk(spark, root)


def test_days_of_a_listing_equal_the_calendar(spark, tmp_path):
    d = write_files(tmp_path, {
        "user.application.2020-01-16.csv": "u1,a\n", "user.application.2020-01-17.csv": "", "sub/user.application.2020-01-18-00-30.csv": "",
        "user.application.2020-02-31.csv": "", "user.application.x.csv": "", "user.device.2020-01-19.csv": "", "xuser.application.2020-01-20.csv": "",
    })
    got = sorted(r.day for r in days_listed(walk(spark, d, 1)).collect())
    assert got == sorted(r.day for r in day_calendar(spark, d, recursive=True).distinct().collect()) and len(got) == 3


def test_two_writers_at_once_write_two_results(spark, tmp_path):
    result = aggregate_logs(fixtures.logs(spark, SF001), "2024-01-01 00:00:00", "2024-01-03 00:00:00")
    paths, errors = [], []

    def write():
        try:
            paths.append(write_result(result, str(tmp_path)))
        except Exception as e:  # noqa: BLE001 - reported below
            errors.append(e)

    writers = [threading.Thread(target=write) for _ in range(4)]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    assert not errors and sorted(map(os.path.basename, paths)) == ["result.csv", "result_1.csv", "result_2.csv", "result_3.csv"]
    assert sorted(n for n in os.listdir(tmp_path) if not n.startswith(".")) == sorted(map(os.path.basename, paths))
    assert all(any(n.startswith("part-") for n in os.listdir(p)) for p in paths)


def test_a_claimed_name_is_passed_over(spark, tmp_path):
    write_files(tmp_path, {"_claim-result.csv": "", "_claim-result_1.csv": ""})
    result = aggregate_logs(fixtures.logs(spark, SF001), "2024-01-01 00:00:00", "2024-01-03 00:00:00")
    assert os.path.basename(write_result(result, str(tmp_path))) == "result_2.csv"
