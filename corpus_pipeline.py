"""Corpus pipeline over the documents table: quality rules, language, near
duplicates, mixing to target weights, packing.

Each stage gets what its predecessor kept as ``docs`` and returns the columns of
documents, but for the last, which returns the packed pieces.
"""

from pyspark.sql import functions as F

from logloom.llm import language, minhash, mixing, packing, rules
from logloom.llm.common import stage as written

#: The least cosine with a prototype for languages with too few documents to learn it.
LEAST_LANGUAGE_SCORE = 0.05


def quality_rules(spark, docs, sf_dir):
    """Documents that pass the fixed rules and the list learned from labels."""
    found = rules.learn_from(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    judged = rules.judge(docs, found)
    return judged.where("verdict.kept").select(*[f"`{c}`" for c in docs.columns])


def language_id(spark, docs, sf_dir):
    """Documents in a learned language: those without a letter, and those less like
    the prototype than documents of that language and length are, go. Without any
    language to learn from all documents stay."""
    prototypes = language.learn(docs)
    if not prototypes:
        return docs
    judged = written(language.predict(docs.withColumnRenamed("language", "_language"), prototypes), "zstd")
    least = language.least_score(language.least_scores(judged), otherwise=LEAST_LANGUAGE_SCORE)
    kept = judged.where((F.col("language.lang_pred") != language.UNKNOWN) & (F.col("language.score") >= least))
    return kept.select(*[F.col(f"`_{c}`" if c == "language" else f"`{c}`").alias(c) for c in docs.columns])


def near_duplicates(spark, docs, sf_dir):
    """One document of each group of near copies: the one with the smallest id.
    Rows that repeat an id and its text are one document, the least of them by
    its other columns; rows of one id with different texts all stay, as do rows
    without an id."""
    groups = minhash.near_duplicates(docs).where("not kept").select("doc_id").distinct()
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    once = docs.where("doc_id is not null").groupBy("doc_id", F.md5("text").alias("text_md5")).agg(F.min(row).alias("row"))
    kept = once.join(groups, "doc_id", "left_anti").select("row.*")
    return kept.unionByName(docs.where("doc_id is null"))


def mix_sources(spark, docs, sf_dir):
    """The documents that the mix takes, a row for each copy, in its order."""
    return mixing.materialise(docs)


def pack(spark, docs, sf_dir):
    """The pieces of all documents in sequences of at most 1024 tokens."""
    return packing.digest(packing.pack(docs))


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("mix_sources", mix_sources),
    ("pack", pack),
]
#: Learned models and hash draws are not for SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "zstd")
    return docs
