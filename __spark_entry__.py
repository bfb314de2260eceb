"""


Every query reads the driver's tables through the views in
``logloom.plans.fixtures`` (FIXTURES.md §B) and runs over them whole.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom import (
    aggregate_logs,
    app_device_pairs,
    everyday_users,
    repo_sizes,
    run_counts,
    unique_users,
)
from logloom.functions import day_in_name
from logloom.plans import fixtures
from logloom.plans.args import METRICS
from logloom.sinks import csv_line
from logloom.sources import logs_from_lines

try:  # the training-data operators may be absent; their own import errors still show
    import corpus_pipeline
    from logloom.llm import queries as llm
except ModuleNotFoundError as missing:
    if not (missing.name or "").startswith(("logloom.llm", "corpus_pipeline")):
        raise
    llm = corpus_pipeline = None

SMOKE_DIR = "/root/testdata/sf0.001"

# Parameters of the aggregate keys: (from, to, granularity, dimensions, users,
# apps, shifted file days). All dates are in 2024.
AGG_CASES: dict[str, tuple] = {
    "agg_30m_user_app": ("2024-01-01 00:00:00", "2024-01-08 12:30:00", "30m", ("user", "app"), None, None, False),
    "agg_30m_user": ("2024-01-01 00:00:00", "2024-01-08 12:30:00", "30m", ("user",), None, None, False),
    "agg_30m_app": ("2024-01-01 00:00:00", "2024-01-08 12:30:00", "30m", ("app",), None, None, False),
    "agg_30m_total": ("2024-01-01 00:00:00", "2024-01-08 12:30:00", "30m", (), None, None, False),
    "agg_30m_user_app_user2": ("2024-01-01 00:00:00", "2024-01-08 12:30:00", "30m", ("user", "app"), ("user2",), None, False),
    "agg_30m_user_user2": ("2024-01-01 00:00:00", "2024-01-08 12:30:00", "30m", ("user",), ("user2",), None, False),
    "agg_30m_app_user2": ("2024-01-01 00:00:00", "2024-01-08 12:30:00", "30m", ("app",), ("user2",), None, False),
    "agg_1day_user": ("2024-01-05 06:00:00", "2024-01-16 15:00:00", "1day", ("user",), None, None, False),
    "agg_1day_user_multi": ("2024-01-05 06:00:00", "2024-01-16 15:00:00", "1day", ("user",), ("user1", "user2"), None, False),
    "agg_1day_user_app_filter": (
        "2024-01-01 00:00:00", "2024-01-30 23:59:59", "1day", ("user",), ("user1", "user2", "user99"), ("click",), False,
    ),
    "agg_1day_app_only_filter": ("2024-01-05 06:00:00", "2024-01-16 15:00:00", "1day", ("app",), None, ("click", "view"), False),
    "agg_file_date_bound": ("2024-01-05 06:00:00", "2024-01-08 12:00:00", "1day", ("user", "app"), None, None, True),
    # Whole month: every row of events is in range, and every row is grouped.
    "agg_30m_user_app_month": ("2024-01-01 00:00:00", "2024-01-31 00:00:00", "30m", ("user", "app"), None, None, False),
    "agg_1day_user_app_month": ("2024-01-01 00:00:00", "2024-01-31 00:00:00", "1day", ("user", "app"), None, None, True),
    "agg_1day_total_month": ("2024-01-01 00:00:00", "2024-01-31 00:00:00", "1day", (), None, None, False),
}
RUN_COUNTS_CASES = {
    "agg_run_counts": ("2024-01-05 06:00:00", "2024-01-16 15:00:00", "1day", ("user",), None, ("click",), True),
    "agg_run_counts_month": ("2024-01-01 00:00:00", "2024-01-31 00:00:00", "30m", ("user", "app"), None, None, True),
}
# Over raw log lines in many spellings (``fixtures.log_lines``); arguments as a
# command line gives them: comma lists with blanks, "" for no filter, "," for
# the empty user.
TEXT_CASES: dict[str, tuple] = {
    "text_agg_1day_user_app": ("2024-01-03 06:00:00", "2024-01-20 12:30:00", "1day", " app, user ,app", "", " click , view,purchase "),
    "text_agg_30m_empty_user": ("2024-01-01 00:00:00", "2024-01-31 00:00:00", "30m", "user", ",", "click,view,purchase"),
    "text_agg_1day_quoted_user": ("2024-1-2 0:00:00", "2024-01-31 00:00:00", "1day", "user", 'us"er3,user4', "click,view,purchase"),
}
#: Metric text past 64 bits: the digits of ``fixtures.logs`` and 18 zeros.
WIDE_CASE = ("2024-01-05 06:00:00", "2024-01-16 15:00:00", "1day", ("user", "app"), None, None, False)
WIDE_ZEROS = 18
TEXT_COUNTS = ("2024-01-03 06:00:00", "2024-01-20 12:30:00", "1day", "user", "", "click,view")
# Name suffix and day; no day: the whole table.
PAIRS_DAYS = {"": "2024-01-16", "_all": None}
EVERYDAY_CASES = {
    "everyday_users": ("2024-01-03", "click"),
    "everyday_users_0105": ("2024-01-05", "click"),
    "everyday_users_month": ("2024-01-30", "click"),
}
REPO_MIN_MIB = 1024


def _agg_query(case: tuple) -> Callable[[SparkSession, str], DataFrame]:
    from_dt, to_dt, gran, dims, users, apps, shifted = case

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        logs = fixtures.logs(spark, sf_dir, shifted=shifted)
        return aggregate_logs(logs, from_dt, to_dt, gran, dims, users, apps)

    return run


def _run_counts(case: tuple) -> Callable[[SparkSession, str], DataFrame]:
    from_dt, to_dt, gran, dims, users, apps, shifted = case

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run_counts(fixtures.logs(spark, sf_dir, shifted=shifted), from_dt, to_dt, gran, dims, users, apps)

    return run


def _text_agg(case: tuple) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return aggregate_logs(logs_from_lines(fixtures.log_lines(spark, sf_dir)), *case, ordered=True)

    return run


def _text_agg_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums past 64 bits, as text."""
    logs = fixtures.logs(spark, sf_dir)
    logs = logs.withColumns({m: F.concat(F.col(m).cast("string"), F.lit("0" * WIDE_ZEROS)) for m in METRICS})
    result = aggregate_logs(logs, *WIDE_CASE[:-1], wide=True)
    return result.select("timestamp", "user", "app", *[F.col(m).cast("string").alias(m) for m in METRICS])


def _text_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_counts(logs_from_lines(fixtures.log_lines(spark, sf_dir)), *TEXT_COUNTS)


def _text_result_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of the written result: quoted as ``csv.writer`` quotes."""
    result = _text_agg(TEXT_CASES["text_agg_1day_user_app"])(spark, sf_dir)
    return result.select(csv_line(*[F.col(c) for c in result.columns]).alias("line"))


def _file_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = fixtures.file_names(spark, sf_dir).select(day_in_name(F.col("name")).alias("day"))
    return days.where("day is not null").groupBy("day").agg(F.count(F.lit(1)).alias("files"))


def _unique(key: str, pairs_view, day: str | None) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return unique_users(pairs_view(spark, sf_dir), key, day=day)

    return run


def _pairs(day: str | None) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return app_device_pairs(fixtures.user_app(spark, sf_dir), fixtures.user_device(spark, sf_dir), day=day)

    return run


def _everyday(day: str, app: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return everyday_users(fixtures.user_app(spark, sf_dir), day, app, calendar=fixtures.calendar(spark, sf_dir))

    return run


def _repo_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repo_sizes(fixtures.inventory(spark, sf_dir), min_mib=REPO_MIN_MIB)


def entry(spark: SparkSession) -> DataFrame:
    """
    app over the whole month, the shape of the reference's timed query."""
    return queries()["agg_1day_user_app_filter"](spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict[str, Callable[[SparkSession, str], DataFrame]] = {
        name: _agg_query(case) for name, case in AGG_CASES.items()
    }
    for name, case in RUN_COUNTS_CASES.items():
        out[name] = _run_counts(case)
    for name, case in TEXT_CASES.items():
        out[name] = _text_agg(case)
    out["text_agg_wide"] = _text_agg_wide
    out["text_run_counts"] = _text_counts
    out["text_result_lines"] = _text_result_lines
    out["file_days"] = _file_days
    for suffix, day in PAIRS_DAYS.items():
        out["unique_users_per_app" + suffix] = _unique("application", fixtures.user_app, day)
        out["unique_users_per_device" + suffix] = _unique("device", fixtures.user_device, day)
        out["app_device_pairs" + suffix] = _pairs(day)
    for name, (day, app) in EVERYDAY_CASES.items():
        out[name] = _everyday(day, app)
    out["repo_sizes_over"] = _repo_sizes
    if llm is not None:
        out |= llm.QUERIES
        out["pipeline"] = corpus_pipeline.run
    return out


# ---------------------------------------------------------------- oracle SQL
# DuckDB text, written from the same parameters but with DuckDB's own
# functions (time_bucket, strftime, a prefix theta-join for the sizes).

_METRICS_SQL = ", ".join(f"(event_id * {2 * i + 1}) % 1000 + 1 AS metric_{i}" for i in range(1, 10))
_LOGS_SQL = (
    "SELECT ts, 'user' || CAST(user_id AS VARCHAR) AS \"user\", event_type AS app, "
    "CAST(ts AS DATE) AS file_date, " + _METRICS_SQL + " FROM events"
)
_LOGS_SHIFTED_SQL = (
    "SELECT ts, 'user' || CAST(user_id AS VARCHAR) AS \"user\", event_type AS app, "
    "CASE WHEN event_id % 50 = 0 THEN CAST(ts AS DATE) + 1 ELSE CAST(ts AS DATE) END AS file_date, "
    + _METRICS_SQL + " FROM events"
)
_USER_APP_SQL = (
    "SELECT 'user' || CAST(user_id AS VARCHAR) AS \"user\", event_type AS application, "
    "CAST(ts AS DATE) AS day FROM events"
)
_USER_DEV_SQL = (
    "SELECT 'user' || CAST(user_id AS VARCHAR) AS \"user\", "
    "'device' || CAST(event_id % 50 + 1 AS VARCHAR) AS device, CAST(ts AS DATE) AS day FROM events"
)
_CALENDAR_SQL = "SELECT DISTINCT CAST(ts AS DATE) AS day FROM events"
_INVENTORY_SQL = (
    "SELECT '/c/' || CAST(o_custkey % 7 AS VARCHAR) || '/' || CAST(o_custkey AS VARCHAR) || '/o' || "
    "CAST(o_orderkey AS VARCHAR) AS path, 'file' AS kind, CAST(floor(o_totalprice) AS BIGINT) * 1024 AS bytes "
    "FROM orders "
    "UNION ALL SELECT DISTINCT '/c/' || CAST(o_custkey % 7 AS VARCHAR) || '/' || CAST(o_custkey AS VARCHAR) || "
    "'/.git', 'dir', CAST(4096 AS BIGINT) FROM orders WHERE o_custkey % 3 = 0 "
    "UNION ALL SELECT '/c/0/.git', 'dir', CAST(4096 AS BIGINT)"
)


def _in_sql(column: str, values) -> str:
    return f"{column} IN ({', '.join(repr(v) for v in values)})"


def _period_sql(gran: str) -> str:
    bucket = "time_bucket(INTERVAL '30 minutes', ts)" if gran == "30m" else "date_trunc('day', ts)"
    return f"strftime({bucket}, '%Y-%m-%d %H:%M:%S')"


def _where_sql(from_dt: str, to_dt: str, users, apps) -> str:
    conds = [f"ts >= TIMESTAMP '{from_dt}'", f"ts < TIMESTAMP '{to_dt}'",
             f"file_date BETWEEN DATE '{from_dt[:10]}' AND DATE '{to_dt[:10]}'"]
    if users:
        conds.append(_in_sql('"user"', users))
    if apps:
        conds.append(_in_sql("app", apps))
    return " AND ".join(conds)


def _agg_sql(case: tuple, view_sql: str | None = None) -> str:
    from_dt, to_dt, gran, dims, users, apps, shifted = case
    dim_cols = "".join(f', "{d}"' for d in dims)
    sums = ", ".join(f"CAST(sum(metric_{i}) AS BIGINT) AS metric_{i}" for i in range(1, 10))
    group = ", ".join(str(i) for i in range(1, len(dims) + 2))
    return (
        f"WITH logs AS ({view_sql or (_LOGS_SHIFTED_SQL if shifted else _LOGS_SQL)}) "
        f'SELECT {_period_sql(gran)} AS "timestamp"{dim_cols}, {sums} FROM logs '
        f"WHERE {_where_sql(from_dt, to_dt, users, apps)} GROUP BY {group}"
    )


def _run_counts_sql(case: tuple, view_sql: str | None = None) -> str:
    from_dt, to_dt, gran, dims, users, apps, shifted = case
    dim_cols = "".join(f', "{d}"' for d in dims)
    return (
        f"WITH logs AS ({view_sql or (_LOGS_SHIFTED_SQL if shifted else _LOGS_SQL)}), "
        f"g AS (SELECT {_period_sql(gran)} AS p{dim_cols}, count(*) AS n FROM logs "
        f"WHERE {_where_sql(from_dt, to_dt, users, apps)} GROUP BY ALL) "
        f"SELECT (SELECT count(DISTINCT file_date) FROM logs WHERE file_date BETWEEN DATE '{from_dt[:10]}' "
        f"AND DATE '{to_dt[:10]}') AS files, CAST(coalesce(sum(n), 0) AS BIGINT) AS rows_matched, "
        f"count(*) AS groups FROM g"
    )


# What the raw lines say, told from the event ids alone: which are read, and as what.
_LINES_SQL = (
    "SELECT ts, CASE WHEN event_id % 5 = 1 THEN 'us\"er' || CAST(user_id % 7 AS VARCHAR) "
    "WHEN event_id % 5 = 2 THEN 'a,' || CAST(user_id % 7 AS VARCHAR) WHEN event_id % 10 = 3 THEN '' "
    "ELSE 'user' || CAST(user_id % 7 AS VARCHAR) END AS \"user\", event_type AS app, CAST(ts AS DATE) AS file_date, " + _METRICS_SQL +
    " FROM (SELECT * REPLACE (date_trunc('second', ts) AS ts) FROM events) WHERE event_id % 16 NOT IN (10, 11, 12, 13, 14) AND event_id % 97 <> 5"
)


def _text_case(case: tuple) -> tuple:
    """The case as its arguments are meant."""
    from_dt, to_dt, gran, dims, users, apps = case
    named = [d.strip() for d in dims.split(",")]
    days = tuple(str(datetime.strptime(x, "%Y-%m-%d %H:%M:%S")) for x in (from_dt, to_dt))
    return (*days, gran, tuple(d for d in ("user", "app") if d in named),
            [u.strip() for u in users.split(",")][:1 if users == "," else None] if users else None, [a.strip() for a in apps.split(",")], False)


def _text_result_lines_sql() -> str:
    quoted = "CASE WHEN regexp_matches(\"user\", '[,\"\r\n]') THEN '\"' || replace(\"user\", '\"', '\"\"') || '\"' ELSE \"user\" END"
    metrics = " || ',' || ".join(f"CAST(metric_{i} AS VARCHAR)" for i in range(1, 10))
    return (f"SELECT \"timestamp\" || ',' || {quoted} || ',' || app || ',' || {metrics} AS line "
            f"FROM ({_agg_sql(_text_case(TEXT_CASES['text_agg_1day_user_app']), _LINES_SQL)})")


def _text_agg_wide_sql() -> str:
    sums = ", ".join(f"CAST(CAST(metric_{i} AS HUGEINT) * {10 ** WIDE_ZEROS} AS VARCHAR) AS metric_{i}" for i in range(1, 10))
    return f'SELECT "timestamp", "user", app, {sums} FROM ({_agg_sql(WIDE_CASE)})'


def _day_sql(day: str | None) -> str:
    return "TRUE" if day is None else f"day = DATE '{day}'"


def _unique_sql(view_sql: str, key: str, day: str | None) -> str:
    return (
        f"WITH pairs AS ({view_sql}) SELECT {key}, count(DISTINCT \"user\") AS \"number of unique users\" "
        f"FROM pairs WHERE {_day_sql(day)} GROUP BY {key}"
    )


def _pairs_sql(day: str | None) -> str:
    return (
        f"WITH ua AS ({_USER_APP_SQL}), ud AS ({_USER_DEV_SQL}) "
        f"SELECT DISTINCT a.application, d.device FROM "
        f"(SELECT DISTINCT \"user\", application FROM ua WHERE {_day_sql(day)}) a JOIN "
        f"(SELECT DISTINCT \"user\", device FROM ud WHERE {_day_sql(day)}) d ON a.\"user\" = d.\"user\""
    )


def _everyday_sql(day: str, app: str) -> str:
    return (
        f"WITH ua AS ({_USER_APP_SQL}), cal AS ({_CALENDAR_SQL}) "
        f"SELECT \"user\" FROM ua WHERE application = '{app}' AND day <= DATE '{day}' GROUP BY \"user\" "
        f"HAVING count(DISTINCT day) = (SELECT count(*) FROM cal WHERE day <= DATE '{day}')"
    )


def _repo_sizes_sql() -> str:
    return (
        f"WITH inv AS ({_INVENTORY_SQL}), "
        "roots AS (SELECT DISTINCT CASE WHEN path = '/.git' THEN '/' ELSE substr(path, 1, length(path) - 5) END AS root FROM inv "
        "WHERE kind = 'dir' AND suffix(path, '/.git')) "
        "SELECT r.root, CAST((sum(i.bytes) + 1048575) // 1048576 AS BIGINT) AS size_mb "
        "FROM roots r JOIN inv i ON i.path = r.root OR starts_with(i.path, rtrim(r.root, '/') || '/') "
        f"GROUP BY r.root HAVING (sum(i.bytes) + 1048575) // 1048576 > {REPO_MIN_MIB}"
    )


def oracle_sql() -> dict[str, str]:
    out = {name: _agg_sql(case) for name, case in AGG_CASES.items()}
    for name, case in RUN_COUNTS_CASES.items():
        out[name] = _run_counts_sql(case)
    for name, case in TEXT_CASES.items():
        out[name] = _agg_sql(_text_case(case), _LINES_SQL)
    out["text_agg_wide"] = _text_agg_wide_sql()
    out["text_run_counts"] = _run_counts_sql(_text_case(TEXT_COUNTS), _LINES_SQL)
    out["text_result_lines"] = _text_result_lines_sql()
    out["file_days"] = "SELECT CAST(ts AS DATE) AS day, count(*) AS files FROM events WHERE event_id % 5 IN (0, 1, 4) GROUP BY 1"
    for suffix, day in PAIRS_DAYS.items():
        out["unique_users_per_app" + suffix] = _unique_sql(_USER_APP_SQL, "application", day)
        out["unique_users_per_device" + suffix] = _unique_sql(_USER_DEV_SQL, "device", day)
        out["app_device_pairs" + suffix] = _pairs_sql(day)
    for name, (day, app) in EVERYDAY_CASES.items():
        out[name] = _everyday_sql(day, app)
    out["repo_sizes_over"] = _repo_sizes_sql()
    if llm is not None:
        out |= llm.ORACLES
        if corpus_pipeline.ORACLE_SQL is not None:
            out["pipeline"] = corpus_pipeline.ORACLE_SQL
    return out
