"""Plan shape of every registered query: what must hold at any scale.

No Cartesian or nested-loop join, no Python evaluation, only the columns a
query uses read from the scan, the time range pushed into it, and a single
exchange between the partial and the final sum of an aggregate.
"""

import contextlib
import io
import re

import pytest
from conftest import SF001
from oracle import own

import __spark_entry__ as entry

FORBIDDEN = (
    "CartesianProduct",
    "BroadcastNestedLoopJoin",
    "BatchEvalPython",
    "ArrowEvalPython",
    "FlatMapGroupsInPandas",
    "MapInPandas",
    "PythonUDF",
)
# The events columns no registered query needs.
UNUSED_EVENT_COLUMNS = ("value:", "props:")


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def tree(text: str) -> str:
    return text.partition("\n\n\n")[0]


def node_details(text: str, kind: str) -> list[str]:
    """The detail blocks of every node whose name starts with ``kind``."""
    blocks = re.split(r"\n(?=\(\d+\) )", text.partition("\n\n\n")[2])
    return [b for b in blocks if re.match(rf"\(\d+\) {kind}", b)]


@pytest.fixture(scope="module")
def plans(spark):
    queries = entry.queries()
    return {name: plan_text(queries[name](spark, SF001)) for name in own(queries)}


def test_no_cartesian_join_and_no_python(plans):
    for name, text in plans.items():
        for node in FORBIDDEN:
            assert node not in text, f"{name}: {node}"


def test_scans_read_only_used_columns(plans):
    for name, text in plans.items():
        for scan in node_details(text, "Scan parquet"):
            schema = re.search(r"ReadSchema: (.*)", scan).group(1)
            for col in UNUSED_EVENT_COLUMNS:
                assert col not in schema, f"{name}: reads {col} ({schema})"


AGG_KEYS = sorted(entry.AGG_CASES)


@pytest.mark.parametrize("name", AGG_KEYS)
def test_aggregate_is_one_exchange_with_pushed_range(plans, name):
    text = plans[name]
    assert tree(text).count("Exchange") == 1, name
    scans = node_details(text, "Scan parquet")
    assert len(scans) == 1
    pushed = re.search(r"PushedFilters: (.*)", scans[0]).group(1)
    assert "GreaterThanOrEqual(ts," in pushed and "LessThan(ts," in pushed, pushed


def test_app_filter_reaches_the_scan(plans):
    scans = node_details(plans["agg_1day_user_app_filter"], "Scan parquet")
    assert "EqualTo(event_type,click)" in re.search(r"PushedFilters: (.*)", scans[0]).group(1)
    scans = node_details(plans["agg_1day_app_only_filter"], "Scan parquet")
    assert "In(event_type, [click,view])" in re.search(r"PushedFilters: (.*)", scans[0]).group(1)


def test_repo_sizes_has_no_join(plans):
    assert "Join" not in tree(plans["repo_sizes_over"])


def test_everyday_users_joins_only_the_calendar_days(plans):
    """The one join is a semi-join on the day: rows on unlisted days must not count."""
    for name in entry.EVERYDAY_CASES:
        shape = tree(plans[name])
        final = shape.split("Initial Plan")[0]
        joins = re.findall(r"\S*Join\S* \S*", final)
        assert len(joins) == 1 and "LeftSemi" in joins[0], (name, joins)


def test_csv_path_map_side_is_one_codegen_stage(spark, tmp_path):
    # From the scan's filter to the partial sum, including the Generate that
    # parses each timestamp once, the map side compiles to one Java stage.
    from conftest import write_files

    from logloom import aggregate_logs
    from logloom.sources import read_logs

    m = ",".join(["1"] * 9)
    d = write_files(tmp_path, {"2025-01-01.log.csv": f"2025-01-01 10:00:00,u1,a,{m}\n"})
    args = ("2025-01-01 00:00:00", "2025-01-02 00:00:00", "1day", "user", "u1,u2", "a")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # codegen ids show before execution
    try:
        text = plan_text(aggregate_logs(read_logs(spark, d, args[0], args[1]), *args))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    nodes = re.findall(r"^\(\d+\) (\w+)(?: \[codegen id : (\d+)\])?", text.partition("\n\n\n")[2], re.M)
    names = [n for n, _ in nodes]
    map_side = nodes[names.index("Filter"): names.index("Exchange")]
    assert "Generate" in [n for n, _ in map_side] and "HashAggregate" in [n for n, _ in map_side]
    assert {c for _, c in map_side} == {"1"}, map_side
