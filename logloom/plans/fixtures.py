"""Views over the driver's parquet tables in the shapes the operators take.

``events`` becomes the log table, the user–application and user–device pair
tables and the day calendar; ``orders`` becomes a file inventory. Each view
is a lazy projection of a parquet scan, so filters and column pruning still
reach the scan.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .args import METRICS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table (read-only parquet)."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _metric(i: int):
    # metric_i = (event_id * (2i + 1)) % 1000 + 1: exact integers in any engine.
    return (F.col("event_id") * (2 * i + 1)) % 1000 + 1


def logs(spark: SparkSession, sf_dir: str, shifted: bool = False) -> DataFrame:
    """``ts, user, app, file_date, metric_1..metric_9`` from ``events``.

    ``shifted=True`` files every 50th event under the next day, so the file
    day and the timestamp disagree for those rows.
    """
    ev = table(spark, sf_dir, "events")
    day = F.to_date("ts")
    if shifted:
        day = F.when(F.col("event_id") % 50 == 0, F.date_add(day, 1)).otherwise(day)
    return ev.select(
        "ts",
        F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("user"),
        F.col("event_type").alias("app"),
        day.alias("file_date"),
        *[_metric(i).alias(m) for i, m in enumerate(METRICS, start=1)],
    )


def user_app(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``user, application, day`` of every event, repeats included."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("user"),
        F.col("event_type").alias("application"),
        F.to_date("ts").alias("day"),
    )


def user_device(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``user, device, day`` of every event, repeats included; 50 devices derived from the event id."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("user"),
        F.concat(F.lit("device"), (F.col("event_id") % 50 + 1).cast("string")).alias("device"),
        F.to_date("ts").alias("day"),
    )


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct ``day`` over all events: the days that have a file."""
    return table(spark, sf_dir, "events").select(F.to_date("ts").alias("day")).distinct()


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``path, kind, bytes`` for a tree ``/c/<custkey % 7>/<custkey>/o<orderkey>``.

    Every third customer directory holds a ``.git`` directory, and ``/c/0``
    holds one too, so ``/c/0`` is a repository that contains repositories.
    """
    orders = table(spark, sf_dir, "orders")
    cust_dir = F.concat(
        F.lit("/c/"), (F.col("o_custkey") % 7).cast("string"), F.lit("/"), F.col("o_custkey").cast("string")
    )
    files = orders.select(
        F.concat(cust_dir, F.lit("/o"), F.col("o_orderkey").cast("string")).alias("path"),
        F.lit("file").alias("kind"),
        (F.floor("o_totalprice").cast("bigint") * 1024).alias("bytes"),
    )
    gits = (
        orders.filter(F.col("o_custkey") % 3 == 0)
        .select(
            F.concat(cust_dir, F.lit("/.git")).alias("path"),
            F.lit("dir").alias("kind"),
            F.lit(4096).cast("bigint").alias("bytes"),
        )
        .distinct()
    )
    top = orders.sparkSession.range(1).select(
        F.lit("/c/0/.git").alias("path"), F.lit("dir").alias("kind"), F.lit(4096).cast("bigint").alias("bytes")
    )
    return files.unionByName(gits).unionByName(top)


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``value, file_date``: every event as a raw CSV line, in many spellings.

    By event id: timestamps padded or not, two spaces apart, or in forms that no
    strict parse takes; 11, 12 or 13 fields; users plain, empty, quoted with a
    comma or a doubled quote; metrics with spaces, a sign, an underscore. One
    event in 97 has the app ``broken`` and a metric that is no number.
    """
    ev = table(spark, sf_dir, "events")
    e = F.col("event_id")
    form, user = e % 16, (F.col("user_id") % 7).cast("string")
    text = F.substring(F.col("ts").cast("string"), 1, 19)
    unpadded = F.replace(F.replace(F.replace(text, F.lit("-0"), F.lit("-")), F.lit(" 0"), F.lit(" ")), F.lit(":0"), F.lit(":"))
    stamp = (
        F.when(form == 8, unpadded)
        .when(form == 9, F.replace(text, F.lit(" "), F.lit("  ")))
        .when(form == 10, F.replace(text, F.lit(" "), F.lit("T")))
        .when(form == 11, F.concat(F.lit(" "), text))
        .when(form == 12, F.concat(text, F.lit(".5")))
        .when(form == 13, F.lit("2024-02-30 10:00:00"))
        .otherwise(text)
    )
    name = (
        F.when(e % 5 == 1, F.concat(F.lit('"us""er'), user, F.lit('"')))
        .when(e % 5 == 2, F.concat(F.lit('"a,'), user, F.lit('"')))
        .when(e % 10 == 3, F.lit(""))
        .otherwise(F.concat(F.lit("user"), user))
    )
    broken = e % 97 == 5
    app = F.when(broken, F.lit("broken")).otherwise(F.col("event_type"))

    def metric(i: int):
        n = _metric(i).cast("string")
        spelled = (
            F.when((e + i) % 4 == 1, F.concat(F.lit(" "), n, F.lit(" ")))
            .when((e + i) % 4 == 2, F.concat(F.lit("+"), n))
            .when((e + i) % 4 == 3, F.regexp_replace(n, r"([0-9])([0-9])$", "$1_$2"))
            .otherwise(n)
        )
        return F.when(broken & F.lit(i == 3), F.lit("x")).otherwise(spelled)

    last = F.when(form == 14, F.lit("")).otherwise(F.concat(F.lit(","), metric(9)))
    more = F.when(form == 15, F.lit(",more")).otherwise(F.lit(""))
    fields = F.concat_ws(",", stamp, name, app, *[metric(i) for i in range(1, 9)])
    return ev.select(F.concat(fields, last, more).alias("value"), F.to_date("ts").alias("file_date"))


def file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``name``: a file name for each event, some without a day or with none that exists."""
    e = F.col("event_id")
    day = F.to_date("ts").cast("string")
    return table(spark, sf_dir, "events").select(
        F.when(e % 5 == 0, F.concat(F.lit("user.application."), day, F.lit("-10-30.csv")))
        .when(e % 5 == 1, F.concat(F.lit("x"), day, F.lit(".log")))
        .when(e % 5 == 2, F.lit("user.application.2024-13-01.csv"))
        .when(e % 5 == 3, F.lit("notes.csv"))
        .otherwise(F.concat(day, F.lit(".log.csv")))
        .alias("name")
    )
