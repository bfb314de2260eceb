"""A key holding a third of all rows is combined before it is shuffled:
the exchange carries at most one partial row per map task and group."""

from conftest import SF01
from pyspark.sql import functions as F

from logloom import aggregate_logs, repo_sizes, unique_users
from logloom.plans import fixtures


def shuffle_records(df) -> list[int]:
    """Records written by each exchange of the executed (adaptive) plan,
    from the top of the plan down (the last exchange first)."""
    out = []

    def walk(p):
        name = p.nodeName()
        if name == "AdaptiveSparkPlan":
            walk(p.executedPlan())
            return
        if "QueryStage" in p.getClass().getSimpleName():  # shuffle and result stages
            walk(p.plan())
            return
        if name == "Exchange" and p.metrics().contains("shuffleRecordsWritten"):
            out.append(p.metrics().apply("shuffleRecordsWritten").value())
        for i in range(p.children().size()):
            walk(p.children().apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return out


def test_hot_user_is_combined_before_the_exchange(spark):
    logs = fixtures.logs(spark, SF01).withColumn(
        "user", F.when(F.col("metric_1") % 3 == 0, F.lit("hot")).otherwise(F.col("user"))
    )
    tasks = logs.rdd.getNumPartitions()
    n_rows = logs.count()
    hot_rows = logs.filter("user = 'hot'").count()
    assert 3 * hot_rows > n_rows * 0.9  # about a third
    df = aggregate_logs(logs, "2024-01-01 00:00:00", "2024-01-31 00:00:00", "1day", "user")
    res = df.collect()
    (records,) = shuffle_records(df)
    # every non-hot row may stay separate, the hot ones collapse per task and day
    assert records <= (n_rows - hot_rows) + 30 * tasks
    assert records < n_rows - hot_rows / 2
    assert sum(r.metric_1 for r in res) == logs.agg(F.sum("metric_1")).first()[0]


def test_hot_key_in_unique_users(spark):
    ua = fixtures.user_app(spark, SF01).withColumn(
        "application", F.when(F.length("user") % 3 == 0, F.lit("hot")).otherwise(F.col("application"))
    )
    df = unique_users(ua, "application", day="2024-01-16")
    expected = {
        r.application: r.n
        for r in ua.filter("day = DATE'2024-01-16'").groupBy("application").agg(F.countDistinct("user").alias("n")).collect()
    }
    assert {r.application: r["number of unique users"] for r in df.collect()} == expected
    records = shuffle_records(df)
    # the last exchange carries one partial count per task and key
    assert records[0] <= len(expected) * 8 * 2


def test_hot_repository_is_combined_before_the_exchange(spark):
    inv = fixtures.inventory(spark, SF01)
    # a third of the files move into one repository, /c/1/9
    hot_file = (F.col("kind") == "file") & (F.abs(F.hash("path")) % 3 == 0)
    hot = inv.withColumn(
        "path", F.when(hot_file, F.concat(F.lit("/c/1/9/"), F.regexp_extract("path", "[^/]+$", 0))).otherwise(F.col("path"))
    ).union(spark.range(1).selectExpr("'/c/1/9/.git' AS path", "'dir' AS kind", "CAST(4096 AS BIGINT) AS bytes"))
    rows = hot.collect()
    n_files = sum(1 for r in rows if r.kind == "file")
    n_hot = sum(1 for r in rows if r.path.startswith("/c/1/9/") and r.kind == "file")
    assert 3 * n_hot > n_files * 0.9
    tasks = hot.rdd.getNumPartitions()
    df = repo_sizes(hot, 0)
    got = {r.root: r.size_mb for r in df.collect()}
    total = sum(r.bytes for r in rows if r.path.startswith("/c/1/9/"))
    assert got["/c/1/9"] == -(-total // (1 << 20))
    (records,) = shuffle_records(df)[:1]
    # a file reaches the exchange only through its directories; the hot
    # repository's files collapse to its three directory levels per task
    assert records <= 3 * (n_files - n_hot) + 3 * tasks + 2 * (len(rows) - n_files)


def _hot_user(df, share: int = 3):
    # about one row in `share` belongs to one user
    return df.withColumn("user", F.when(F.abs(F.hash(*df.columns)) % share == 0, F.lit("hot")).otherwise(F.col("user")))


def test_hot_user_in_app_device_pairs(spark):
    from logloom import app_device_pairs

    day = "2024-01-16"
    ua = _hot_user(fixtures.user_app(spark, SF01))
    ud = _hot_user(fixtures.user_device(spark, SF01))
    apps = {(r.user, r.application) for r in ua.filter(f"day = DATE'{day}'").collect()}
    devices = {(r.user, r.device) for r in ud.filter(f"day = DATE'{day}'").collect()}
    assert 3 * sum(1 for u, _ in devices if u == "hot") > len(devices) * 0.5
    expected = {(a, d) for u, a in apps for v, d in devices if u == v}
    df = app_device_pairs(ua, ud, day)
    assert {(r.application, r.device) for r in df.collect()} == expected
    # each side reaches the join as its distinct (user, key) rows, so the hot
    # user sends at most one row per key per task into the join exchange
    records = shuffle_records(df)
    tasks = 8
    assert max(records) <= max(len(expected), len(apps) + len(devices)) * tasks


def test_hot_user_in_everyday_users(spark):
    from logloom import everyday_users

    ua = _hot_user(fixtures.user_app(spark, SF01), share=2)
    rows = ua.filter("application = 'click' AND day <= DATE'2024-01-06'").collect()
    days = {r.day for r in fixtures.calendar(spark, SF01).collect() if str(r.day) <= "2024-01-06"}
    per_user = {}
    for r in rows:
        per_user.setdefault(r.user, set()).add(r.day)
    expected = sorted(u for u, ds in per_user.items() if ds == days)
    assert "hot" in expected
    df = everyday_users(ua, "2024-01-06", "click", calendar=fixtures.calendar(spark, SF01))
    assert sorted(r.user for r in df.collect()) == expected
    # the hot user is at most one (user, day) row per task and day in the
    # first exchange, one partial count per task in the second
    records = shuffle_records(df)
    assert records[0] <= len(per_user) * 8


def test_pairs_of_a_user_with_very_many_keys_spread_over_tasks(spark):
    from collections import Counter

    from logloom.operators.usage import blocked_join, join_pairs

    apps = spark.range(2000).selectExpr("'hot' AS user", "concat('app', id) AS application").union(
        spark.createDataFrame([("u1", "app1"), ("u1", "x"), (None, "y"), ("lone", "z")], "user string, application string"))
    devices = spark.range(1500).selectExpr("'hot' AS user", "concat('dev', id) AS device").union(
        spark.createDataFrame([("u1", "dev1"), ("u1", "d"), (None, "y")], "user string, device string"))
    keep = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    for k, v in zip(keep, ("32", "false", "-1")):
        spark.conf.set(k, v)
    try:
        joined = blocked_join(apps, devices, block_keys=200)
        per_task = Counter({r.t: r.n for r in joined.groupBy(F.spark_partition_id().alias("t")).agg(F.count("*").alias("n")).collect()})
        # ten blocks by eight: no task meets more than a few of the eighty
        assert sum(per_task.values()) == 2000 * 1500 + 4 and max(per_task.values()) < 2000 * 1500 / 6
        assert joined.distinct().count() == 2000 * 1500 + 4
        assert {tuple(r) for r in join_pairs(apps, devices, 200).where("application = 'x' OR device = 'd'").collect()} == {("x", "dev1"), ("x", "d"), ("app1", "d")}
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)


def test_deep_trees_shuffle_directories_not_files(spark):
    # 40,000 files, eight levels deep, in 20 directories
    path = "concat('/a/b/c/d/e/f/g', id % 20, '/file', id)"
    inv = spark.range(40_000).selectExpr(f"{path} AS path", "'file' AS kind", "1L AS bytes").union(
        spark.createDataFrame([("/a/b/.git", "dir", 0)], "path string, kind string, bytes long"))
    df = repo_sizes(inv, 0)
    assert [tuple(r) for r in df.collect()] == [("/a/b", 1)]
    assert max(shuffle_records(df)) <= 20 * 2 * inv.rdd.getNumPartitions() + 10
