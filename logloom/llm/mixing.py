"""Mixing sources to target weights by weighted fair queueing, in Spark columns.

Documents are shuffled by a hash of their id. In that order each source is a
queue, repeated when its target exceeds its size, and a copy's virtual finish
time is the words its source has served up to it divided by the source's
weight. Sorting all copies by finish time and stopping at the total budget
serves every source in proportion to its weight; the last copy of a source is
cut at the budget.

A running sum over a hot source must not be one task: the queue is divided by
hash into ``buckets``, sums per (source, bucket) are accumulated first, and
each bucket runs its own sum on top of what precedes it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, stage, words

#: Weights given to the sources by code point, repeating, null last.
WEIGHTS = (5, 2, 1)


def word_count(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.size(F.filter(F.split(text, SPACE), lambda w: w != "")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = 3, budget_share: float = 1.0) -> DataFrame:
    """Of (source, size): one row (source, source_size, weight, target, level).

    The budget is budget_share of all sizes. A source's target is weight *
    level, stopped at max_repeats times its size; level is the finish time at
    which the targets fill the budget. One row for each source goes through one
    task here, never one for each document.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source"))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(rank - 1, F.lit(len(weights))) + 1).cast("int"))
    per = per.withColumn("weight", weight.cast("double")).withColumn("most", F.col("source_size") * F.lit(float(max_repeats)))
    # stop the sources in the order in which they reach their maximum
    full = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").isNull(), "source")
    before = full.rowsBetween(Window.unboundedPreceding, -1)
    everyone = Window.partitionBy()
    per = per.withColumns({
        "budget": F.sum("source_size").over(everyone) * F.lit(float(budget_share)),
        "stopped": F.coalesce(F.sum("most").over(before), F.lit(0.0)),
        "open_weight": F.sum("weight").over(everyone) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
    })
    level = (F.col("budget") - F.col("stopped")) / F.col("open_weight")
    # the level if this and all later sources are open; the highest that holds is it
    holds = F.when(level * F.col("weight") <= F.col("most"), level)
    per = per.withColumn("level", F.coalesce(F.max(holds).over(everyone), F.max(F.col("most") / F.col("weight")).over(everyone)))
    return per.select("source", "source_size", "weight",
                      F.least(F.col("level") * F.col("weight"), F.col("most")).alias("target"), "level")


def _queued(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: str, buckets: int) -> DataFrame:
    key = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    sized = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").alias("source"),
                        word_count(F.col(f"`{text_col}`")).alias("size"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return sized.withColumn("key", key).withColumn(
        "bucket", F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * buckets / F.lit(1 << 32)).cast("int"))


def _served(queued: DataFrame, sizes: DataFrame, weights, max_repeats, budget_share, *carry: str) -> DataFrame:
    """queued with what its queue serves; sizes: the same rows, written, without the texts."""
    targets = source_targets(sizes, weights, max_repeats, budget_share)
    # what precedes each bucket of a source's queue
    queue = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.groupBy("source", "bucket").agg(F.sum("size").alias("in_bucket")).withColumn(
        "start", F.coalesce(F.sum("in_bucket").over(queue), F.lit(0)))
    table = starts.alias("s").join(targets.alias("t"), F.expr("s.source <=> t.source")).select(
        "s.source", "s.bucket", "s.start", "t.source_size", "t.weight", "t.target")
    inside = Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    served = queued.withColumn("upto", F.sum("size").over(inside)).alias("d").join(
        table.alias("s"), F.expr("d.bucket = s.bucket and d.source <=> s.source"))
    served = served.selectExpr("d.doc_id", "d.source", "d.size", "s.source_size", "s.weight", "s.target",
                               "s.start + d.upto as upto", *[f"d.{c}" for c in carry])
    # words served by whole rounds of the source, and by the round the target falls into
    rounds = F.when(F.col("source_size") > 0, F.floor(F.round("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    served = served.withColumn("rounds", rounds)
    rest = F.round("target").cast("long") - F.col("rounds") * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - (F.col("upto") - F.col("size"))))
    return served.withColumn("part", part.cast("long"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", *,
        weights: tuple[int, ...] = WEIGHTS, max_repeats: int = 3, budget_share: float = 1.0, seed: str = "mix",
        buckets: int = 1024) -> DataFrame:
    """The plan of the mix, one row for each row of docs: doc_id, source, size,
    source_size, target, taken, finish (virtual finish time of the first copy).

    taken is the number of words that the mix takes of the document, repeats
    counted: whole copies while the source's queue is under its target, and the
    part that still fits of the copy that crosses it, so that a source's taken
    words add up to its target to within a word. Null and empty texts have size
    0 and take nothing. Null ids and sources are values like any other (null
    sources come last). Rows that repeat an id queue behind each other. An
    empty table gives an empty mix; other columns are not read.
    """
    sizes = stage(_queued(docs, id_col, text_col, source_col, seed, buckets).drop("row"))
    return _served(sizes, sizes, weights, max_repeats, budget_share).select(
        "doc_id", "source", "size", "source_size", F.col("target").cast("double").alias("target"),
        (F.col("rounds") * F.col("size") + F.col("part")).cast("long").alias("taken"),
        (F.col("upto") / F.col("weight")).alias("finish"),
    )


def materialise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", *,
                weights: tuple[int, ...] = WEIGHTS, max_repeats: int = 3, budget_share: float = 1.0, seed: str = "mix",
                buckets: int = 1024) -> DataFrame:
    """The mixed documents themselves: docs' columns, a row for each copy that
    the mix takes, globally sorted by virtual finish time. The one copy of a
    source that the budget cuts holds its first words, joined by spaces.
    Documents without words take nothing and do not occur."""
    queued = _queued(docs, id_col, text_col, source_col, seed, buckets)
    sizes = stage(queued.drop("row"))
    served = _served(queued, sizes, weights, max_repeats, budget_share, "row", "key")
    copies = served.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rounds")))).withColumn(
        "serve", F.when(F.col("copy") < F.col("rounds"), F.col("size")).otherwise(F.col("part"))).where("serve > 0")
    finish = (F.col("copy") * F.col("source_size") + F.col("upto")) / F.col("weight")
    text = F.col(f"row.`{text_col}`")
    cut = F.when(F.col("serve") < F.col("size"), F.array_join(F.slice(words(text), 1, F.col("serve").cast("int")), " ")).otherwise(text)
    return copies.orderBy(finish, "key", "copy").select(
        *[cut.alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


ORACLE_SQL = r"""
WITH sized AS (
  SELECT doc_id, source,
         CAST(len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS BIGINT) AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS key
  FROM documents),
per AS (
  SELECT source, CAST(sum(size) AS DOUBLE) AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) AS r FROM sized GROUP BY source),
weighed AS (
  SELECT source, source_size, 3 * source_size AS most,
         CASE (r - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight FROM per),
-- a level that stops exactly the sources whose ratio is below it
levels AS (
  SELECT c.source, c.most / c.weight AS ratio,
         ((SELECT sum(source_size) FROM weighed) - coalesce(sum(o.most) FILTER (WHERE o.most / o.weight < c.most / c.weight), 0))
         / sum(o.weight) FILTER (WHERE o.most / o.weight >= c.most / c.weight) AS level
  FROM weighed c, weighed o GROUP BY c.source, c.most, c.weight),
water AS (SELECT coalesce(max(level) FILTER (WHERE level <= ratio), max(ratio)) AS level FROM levels),
targets AS (
  SELECT source, source_size, least(weight * level, most) AS target FROM weighed, water),
queued AS (
  SELECT s.doc_id, s.size, CAST(t.source_size AS BIGINT) AS source_size, t.target,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id, s.size
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - s.size AS start
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN source_size = 0 THEN 0 ELSE
         floor(round(target) / source_size) * size
         + greatest(0, least(size, round(target) - floor(round(target) / source_size) * source_size - start)) END AS BIGINT) AS taken
FROM queued
"""
