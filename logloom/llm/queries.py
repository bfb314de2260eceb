"""The registered queries of the training-data operators and their oracle SQL.

Each ``opN_<name>(spark, sf_dir)`` applies its operator to the whole intended
table with production parameters and derives the digest columns from the
operator's own result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, embeddings, language, licences, lm, manifest, minhash, mixing, order, packing, phrases, rules, urls
from .common import crc_mod, remove_at_end, scratch_dir


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle_words=3, percent=85, bands=24, rows=5)


def op2_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(_table(spark, sf_dir, "pages"), urls.train())


def op3_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_dir(spark)}/order-{uuid.uuid4().hex}"
    order.materialise(_table(spark, sf_dir, "documents"), path, place=order.stored_place())
    remove_at_end(spark, path)
    shards = order.read(spark, path)
    # the padding is not part of the sequence
    return shards.select("doc_id", "start", "length", "slot", "shard", F.crc32(F.substring("ids", F.lit(1), F.col("length").cast("int") * 2)).alias("ids_crc32"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = crc_mod(F.col("doc_id"), 4) == 2
    prototypes = language.learn(docs.where(~held_out))
    return language.predict(docs.select("doc_id", "text"), prototypes).select(
        "doc_id", held_out.alias("held_out"), "language.lang_pred", "language.score")


def op6_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return licences.scan(docs, licences.learn_from(docs)).select("doc_id", "n_paragraphs", F.array_join("licences", ",").alias("licences"))


def op7_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = rules.learn_from(docs, _table(spark, sf_dir, "labels"))
    return rules.judge(docs, found).select(
        "doc_id", *[F.col(f"stats.{c}") for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        "verdict.base_failed", "verdict.kept", "verdict.rule")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(packing.pack(_table(spark, sf_dir, "documents")))


def op9_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(_table(spark, sf_dir, "documents"), crc_mod(F.col("doc_id"), 5) == 1)


def op10_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf_dir, "documents"))


def op12_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.read_back(chat.format_chats(chat.with_trial(_table(spark, sf_dir, "conversations"))))


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.documents_manifest(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_minhash": op1_minhash,
    "op2_urls": op2_urls,
    "op3_order": op3_order,
    "op4_mixing": op4_mixing,
    "op5_language": op5_language,
    "op6_licences": op6_licences,
    "op7_rules": op7_rules,
    "op8_packing": op8_packing,
    "op9_lm": op9_lm,
    "op10_embeddings": op10_embeddings,
    "op11_phrases": op11_phrases,
    "op12_chat": op12_chat,
    "op13_manifest": op13_manifest,
}
ORACLES: dict[str, str] = {"op4_mixing": mixing.ORACLE_SQL, "op11_phrases": phrases.oracle_sql(), "op12_chat": chat.oracle_sql(), "op13_manifest": manifest.oracle_sql()}
