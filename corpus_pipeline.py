"""Documents to tokens: quality rules, near duplicates, benchmark decontamination, byte-level BPE.

Each stage works on all rows that the one before kept. All stages but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlweave.llm import bpe_codec, decontaminate, minhash, quality_rules
from crawlweave.llm.common import table
from crawlweave.session import stage

#: No SQL: the rules are learned, and similarity is reached over chains of documents.
ORACLE_SQL = None


def _carried(docs: DataFrame) -> DataFrame:
    """The whole row aside, so that no column of it meets those that an operator makes."""
    return docs.select(F.struct("*").alias("row"), "doc_id", "text")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the base rules and the learned decision list keep."""
    rules = quality_rules.learn(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return quality_rules.judge(_carried(docs), rules).where("kept").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates, the one with the least identifier; rows without words all stay.

    Rows are told apart by a key of their own, so missing and repeated identifiers neither keep copies nor lose texts.
    """
    keyed = stage(docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("key")), "keyed")
    groups = minhash.near_duplicates(keyed.select("key", F.col("row.text").alias("text")), "key").select(F.col("doc_id").alias("key"), "component_id")
    rank = F.struct(F.col("row.doc_id").isNull().alias("none"), F.col("row.doc_id").alias("id"), F.xxhash64("row.text").alias("h"), "key")
    best = keyed.select("key", rank.alias("rank")).join(groups, "key").groupBy("component_id").agg(F.min("rank").alias("rank"))
    return keyed.join(best.select("rank.key"), "key", "left_semi").select("row.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that benchmark passages do not contaminate."""
    judged = decontaminate.judge(_carried(docs), table(spark, sf_dir, "benchmark"))
    return judged.where(~F.col("contaminated")).select("row.*")


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the bytes they decode to."""
    return bpe_codec.digests(spark, docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality rules", quality), ("near duplicates", near_duplicates), ("benchmark decontamination", decontamination),
    ("byte-level BPE", encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
