"""The numbered queries over the given tables, and their reference SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline
from shopmart.llm import bpe, licenses, negatives, oracles, packing, quality_rules, ranking, secret_scan, sharding, simhash, token_counts, topk, toxicity, url_filter
from shopmart.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").where(~toxicity.held_out(F.col("doc_id")))
    found = toxicity.toxicity(table(spark, sf_dir, "documents"), labels)
    return found.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= toxicity.THRESHOLD, 1).otherwise(0).alias("predicted"),
        F.size("offending").alias("n_offending"),
    )


def op3_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "source",
    )


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), bpe.vocabulary_path())


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.judge(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op7_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), token_counts.vocabulary_path())


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), bpe.vocabulary_path())


def op11_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan(table(spark, sf_dir, "documents")))


def op12_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, noisy)


def queries() -> dict[str, Query]:
    return {"op1_topk": op1_topk, "op2_toxicity": op2_toxicity, "op3_shards": op3_shards, "op4_licenses": op4_licenses, "op5_bpe": op5_bpe, "op6_quality": op6_quality, "op7_urls": op7_urls, "op8_simhash": op8_simhash, "op9_token_counts": op9_token_counts, "op10_packing": op10_packing, "op11_secrets": op11_secrets, "op12_ranking": op12_ranking, "op13_negatives": op13_negatives, "pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return oracles.statements()
