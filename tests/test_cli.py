"""The command line: the original tools' flags over small literal files."""

import glob
import os

from conftest import write_files

from logloom.cli import main

M = "1,2,3,4,5,6,7,8,9"


def test_aggregate_command(spark, tmp_path, capsys):
    logs = write_files(tmp_path / "logs", {
        "2025-01-01.log.csv": f"2025-01-01 10:00:00,user1,facebook,{M}\n2025-01-01 11:00:00,user2,twitter,{M}\n",
        "2025-01-02.log.csv": f"2025-01-02 10:00:00,user1,facebook,{M}\n",
        "2025-01-03.log.csv": "",
        "2025-02-30.log.csv": f"2025-01-01 10:00:00,user1,facebook,{M}\n",
        "notes.log.csv": f"2025-01-01 10:00:00,user1,facebook,{M}\n",
    })
    res = str(tmp_path / "results")
    argv = ["aggregate", "--from_datetime=2025-01-01 00:00:00", "--to_datetime=2025-01-03 23:59:59",
            "--granularity=1day", "--dimensions=user", "--user=user1,user2", "--app=facebook",
            f"--logs-dir={logs}", f"--results-dir={res}"]
    assert main(argv) == 0
    out = capsys.readouterr().out
    assert "Processed 3 files, 2 rows matched" in out
    assert main(argv) == 0
    assert sorted(os.listdir(res)) == ["result.csv", "result_1.csv"]
    body = "".join(open(p, newline="").read() for p in sorted(glob.glob(os.path.join(res, "result.csv", "part-*"))))
    assert body.split("\r\n")[1:-1] == ["2025-01-01 00:00:00,user1," + M, "2025-01-02 00:00:00,user1," + M]
    assert main(argv[:-4] + ["--user=nobody", f"--logs-dir={logs}", f"--results-dir={res}"] + argv[-2:-1]) == 0
    assert "No data found matching criteria." in capsys.readouterr().out
    assert main(argv[:4] + ["--dimensions=user,device"] + argv[5:]) == 2


def test_aggregate_counts_only_day_files(spark, tmp_path, capsys):
    # Names that only look like day files are neither read nor counted.
    logs = write_files(tmp_path / "logs", {
        "2025-01-01.log.csv": f"2025-01-01 10:00:00,user1,facebook,{M}\n",
        "2025-01-02-extra.log.csv": f"2025-01-02 10:00:00,user1,facebook,{M}\n",
        "2025-02-30.log.csv": f"2025-02-28 10:00:00,user1,facebook,{M}\n",
    })
    argv = ["aggregate", "--from_datetime=2025-01-01 00:00:00", "--to_datetime=2025-03-01 00:00:00",
            "--granularity=1day", "--dimensions=user", f"--logs-dir={logs}", f"--results-dir={tmp_path / 'res'}"]
    assert main(argv) == 0
    assert "Processed 1 files, 1 rows matched" in capsys.readouterr().out


def test_everyday_and_summaries_commands(spark, tmp_path, capsys):
    d = write_files(tmp_path, {
        "user.application.2020-01-16.csv": "user1,app1\nuser2,app1\n",
        "user.application.2020-01-17.csv": "user1,app1\nuser3,app1\n",
        "ex2/user.application.2020-01-16-00-00.csv": "user1,app1\n",
        "ex2/user.device.2020-01-16-00-00.csv": "user1,dev1\n",
    })
    assert main(["everyday", "2020-01-17", "app1", f"--data-dir={d}"]) == 0
    assert capsys.readouterr().out.strip().endswith("2020-01-17:\nuser1")
    assert main(["everyday", "2020-01-01", "app1", f"--data-dir={d}"]) == 1
    assert main(["summaries", "2020-01-16", f"--data-dir={d}/ex2", f"--results-dir={tmp_path}/res"]) == 0
    assert sorted(os.listdir(tmp_path / "res")) == ["apps_devices.csv", "apps_users.csv", "devices_users.csv"]


def test_repo_sizes_command(spark, tmp_path, capsys):
    # The exercise's mock tree: repo1 small; repo2 1,100 MiB + 1 byte, which
    # rounds up to 1,101 MB as the exercise reports; data as large but without
    # .git; repo3 holds a .git file only.
    mib = 1 << 20
    rows = [
        ("/t/repo1/.git", "dir", 4096), ("/t/repo1/f", "file", 10),
        ("/t/repo2/.git", "dir", 4096), ("/t/repo2/big", "file", 1100 * mib + 1),
        ("/t/data/big", "file", 1100 * mib + 1),
        ("/t/repo3/.git", "file", 10), ("/t/repo3/big", "file", 2000 * mib),
    ]
    inv = str(tmp_path / "inv")
    spark.createDataFrame(rows, "path string, kind string, bytes bigint").write.parquet(inv)
    assert main(["repo-sizes", inv]) == 0
    out = capsys.readouterr().out.splitlines()
    rule = "-" * 35
    assert out == [f"Scanning {inv}...", rule, "Found: /t/repo2", "Size: 1101 MB", rule]


def test_aggregate_multiline_flag(spark, tmp_path, capsys):
    # A user name holding a newline inside quotes is read whole, with the flag or without.
    logs = write_files(tmp_path / "logs", {
        "2025-01-01.log.csv": f'2025-01-01 10:00:00,"us\ner",fb,{M}\n2025-01-01 11:00:00,user1,fb,{M}\n',
    })
    argv = ["aggregate", "--from_datetime=2025-01-01 00:00:00", "--to_datetime=2025-01-02 00:00:00",
            "--granularity=1day", "--dimensions=user", f"--logs-dir={logs}"]
    assert main(argv + [f"--results-dir={tmp_path / 'a'}"]) == 0
    assert "2 rows matched" in capsys.readouterr().out
    assert main(argv + [f"--results-dir={tmp_path / 'b'}", "--multiline"]) == 0
    assert "2 rows matched" in capsys.readouterr().out
    body = "".join(open(p, newline="").read() for p in sorted(glob.glob(os.path.join(tmp_path / "b", "result.csv", "part-*"))))
    # sorted by code point: "us\ner" before "user1"; the newline kept inside quotes
    assert body.split("\r\n")[1:-1] == ['2025-01-01 00:00:00,"us\ner",' + M, "2025-01-01 00:00:00,user1," + M]
