"""Corpus preparation: toxic and poor documents go, near copies are thinned, the rest is packed.

Each stage takes the rows that the one before it kept and all but the last return the columns of
``documents`` unchanged, whatever they are. Stages decide by row, so null ids, repeated rows and
extra columns pass through; an empty table stays empty. ``run`` writes every stage's rows below the
shared folder and reads them again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from shopmart.llm import bpe, packing, quality_rules, simhash, toxicity
from shopmart.llm.common import stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the fitted model does not call toxic."""
    labels = table(spark, sf_dir, "labels").where(~toxicity.held_out(F.col("doc_id")))
    return toxicity.keep_clean(docs, labels)


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and every rule of the cascade."""
    return quality_rules.keep_good(docs)


def thin_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of SimHash links: the one with the least id."""
    return simhash.keep_one(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of the documents that are left."""
    return packing.pack(docs, bpe.vocabulary_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("quality rules", drop_poor),
    ("near duplicates", thin_copies),
    ("packing", pack),
]

#: Fitted scores, hashes of shingles and a vocabulary's ids are beyond SQL; tests hold a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
