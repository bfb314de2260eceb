"""Command line with the original tools' flags; each command is one Spark job
chain over the library functions.

    python -m logloom aggregate --from_datetime="2025-01-01 00:00:00" \\
        --to_datetime="2025-03-31 23:59:59" --granularity=1day --dimensions=user \\
        --user=user1,user2,user99 --app=facebook [--logs-dir csv_logs] [--results-dir results] [--multiline]
    python -m logloom summaries 2020-01-16 [--data-dir DIR] [--results-dir DIR]
    python -m logloom everyday 2020-01-22 app1 [--data-dir DIR]
    python -m logloom repo-sizes INVENTORY [--format parquet] [--min-mib 1024]
    python -m logloom repo-sizes DIRECTORY --format tree [--min-mib 1024]
"""

from __future__ import annotations

import argparse
import re
import sys
import time

from pyspark.sql import Observation, SparkSession

from . import aggregate_logs, everyday_users, repo_sizes
from .functions.time import GRANULARITIES, parse_date_arg, parse_datetime_arg
from .plans.args import normalize_dimensions
from .sinks import write_result, write_summaries
from .sources import day_calendar, list_dir, read_daily_pairs, read_inventory, read_logs, read_pairs, walk
from .sources.logs import DAY_FILE_RX, detect_layout


def _files_in_range(spark, logs_dir: str, from_dt, to_dt) -> int:
    """Day files present for the days of the range (a listing, empty files included)."""
    first, last = parse_datetime_arg(from_dt).date().isoformat(), parse_datetime_arg(to_dt).date().isoformat()
    if detect_layout(spark, logs_dir) == "daily":
        days = {e.name.split("=", 1)[1] for e in list_dir(spark, logs_dir) if e.is_dir and e.name.startswith("file_date=")}
    else:
        found = (re.match(DAY_FILE_RX, e.name) for e in list_dir(spark, logs_dir) if not e.is_dir)
        days = {m.group(1) for m in found if m}
    return sum(1 for d in days if first <= d <= last and _is_date(d))


def _is_date(text: str) -> bool:
    # Only files named for a real day are ever read (the reference builds
    # the names from a calendar).
    try:
        parse_date_arg(text)
        return True
    except ValueError:
        return False


def cmd_aggregate(spark: SparkSession, a) -> int:
    from_dt, to_dt = parse_datetime_arg(a.from_datetime), parse_datetime_arg(a.to_datetime)
    try:
        dims = normalize_dimensions(a.dimensions)
    except ValueError as e:
        print(f"error: {e}", file=sys.stderr)
        return 2
    print(f"\nQuerying logs from {from_dt} to {to_dt}")
    print(f"Granularity: {a.granularity} | Dimensions: {list(dims)}")
    t0 = time.perf_counter()
    seen = Observation("run")
    logs = read_logs(spark, a.logs_dir, from_dt, to_dt)
    result = aggregate_logs(logs, from_dt, to_dt, a.granularity, dims, a.user, a.app, observation=seen, wide=a.wide)
    path = write_result(result, a.results_dir, a.output)
    rows = seen.get.get("rows_matched", 0) if path else 0
    files = _files_in_range(spark, a.logs_dir, from_dt, to_dt)
    print(f"Processed {files} files, {rows:,} rows matched")
    print(f"Results saved to: {path}" if path else "No data found matching criteria.")
    print(f"TOTAL {time.perf_counter() - t0:.3f}s")
    return 0


def cmd_summaries(spark: SparkSession, a) -> int:
    print(f"Processing data for {a.date}...")
    ua = read_pairs(spark, a.data_dir, "application", day=a.date)
    ud = read_pairs(spark, a.data_dir, "device", day=a.date)
    for path in write_summaries(ua, ud, a.results_dir).values():
        print(f"Created {path}")
    return 0


def cmd_everyday(spark: SparkSession, a) -> int:
    pairs = read_daily_pairs(spark, a.data_dir)
    try:
        users = everyday_users(pairs, a.date, a.application, calendar=day_calendar(spark, a.data_dir))
    except ValueError as e:
        print(e)
        return 1
    print(f"Users using {a.application} every day up to {a.date}:")
    # Streamed a partition at a time, never held whole on the driver.
    found = False
    for r in users.orderBy("user").toLocalIterator():
        print(r.user)
        found = True
    if not found:
        print("No users found.")
    return 0


def cmd_repo_sizes(spark: SparkSession, a) -> int:
    rule = "-" * 35
    print(f"Scanning {a.inventory}...\n{rule}")
    inventory = walk(spark, a.inventory) if a.format == "tree" else read_inventory(spark, a.inventory, a.format)
    sizes = repo_sizes(inventory, a.min_mib)
    for r in sizes.orderBy("root").toLocalIterator():
        print(f"Found: {r.root}\nSize: {r.size_mb} MB\n{rule}")
    return 0


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m logloom")
    sub = p.add_subparsers(dest="command", required=True)
    ag = sub.add_parser("aggregate", help="metric sums per time bucket")
    ag.add_argument("--from_datetime", "--from-datetime", dest="from_datetime", required=True)
    ag.add_argument("--to_datetime", "--to-datetime", dest="to_datetime", required=True)
    ag.add_argument("--granularity", required=True, choices=sorted(GRANULARITIES))
    ag.add_argument("--dimensions", required=True)
    ag.add_argument("--user")
    ag.add_argument("--app")
    ag.add_argument("--output", default="result.csv")
    ag.add_argument("--threads", type=int, help="accepted for compatibility; Spark decides parallelism")
    ag.add_argument("--logs-dir", default="csv_logs")
    ag.add_argument("--multiline", action="store_true",
                    help="accepted for older command lines: quoted fields that span lines are always read whole")
    ag.add_argument("--wide", action="store_true", help="metrics and sums of up to 38 digits instead of 64 bits")
    ag.add_argument("--results-dir", default="results")
    ag.set_defaults(run=cmd_aggregate)
    su = sub.add_parser("summaries", help="unique users per app and device, app-device pairs")
    su.add_argument("date")
    su.add_argument("--data-dir", default=".")
    su.add_argument("--results-dir", default="results")
    su.set_defaults(run=cmd_summaries)
    ev = sub.add_parser("everyday", help="users of an app on every day up to a date")
    ev.add_argument("date")
    ev.add_argument("application")
    ev.add_argument("--data-dir", default=".")
    ev.set_defaults(run=cmd_everyday)
    rs = sub.add_parser("repo-sizes", help="repositories over a size in an inventory")
    rs.add_argument("inventory")
    rs.add_argument("--format", default="parquet", help="of the inventory; tree: walk a directory instead")
    rs.add_argument("--min-mib", type=int, default=1024)
    rs.set_defaults(run=cmd_repo_sizes)
    return p


def main(argv=None) -> int:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName("logloom").getOrCreate()
    return args.run(spark, args)
