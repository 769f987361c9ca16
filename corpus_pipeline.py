"""The corpus pipeline: stages that each read what the one before has kept.

All stages but the last return the columns of `documents`; the last returns each document's token
ids and the digest of the text decoded from them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemart.llm import bpe, fertility, subsequence, suffixes, superminhash
from tidemart.llm.store import table, written

TOXIC_FROM = 0.3


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the fertility bands."""
    rows = fertility.ruled(docs, public_tokenizers.path("piece_bpe_32k.model"),
                           public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), carry=docs.columns)
    return rows.where("kept").select("row.*")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the toxicity threshold."""
    rows = subsequence.scored(docs, table(spark, sf_dir, "labels"), carry=docs.columns)
    return rows.where(F.col("score") < TOXIC_FROM).select("row.*")


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest doc_id, then class, then text."""
    return superminhash.one_of_each(docs, size=5, percent=85)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any ten-word window of the benchmark."""
    return suffixes.decontaminated(docs, table(spark, sf_dir, "benchmark"), window=10)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and the digest of the decoded text."""
    rows = bpe.encoded(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return rows.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("quality rules", quality), ("toxicity", toxicity), ("near duplicates", one_of_each),
          ("decontamination", decontaminated), ("token ids", tokens)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
