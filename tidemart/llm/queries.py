"""One query per operator of this package, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import alignment, bpe, chat, digests, fertility, grammar, licences, mainblocks, subsequence, suffixes, weaklabel, whitening
from .store import table
from .superminhash import near_duplicates

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op7_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents: five-word shingles, similarity 0.85."""
    return near_duplicates(table(spark, sf_dir, "documents"), size=5, percent=85)


@query
def op5_rank_queue_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of all documents and the texts decoded from them, as digests."""
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@query
def op1_suffix_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten-word benchmark windows that occur in each document, and its longest verbatim match."""
    return suffixes.verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)


@query
def op6_repair_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents in Re-Pair compressed files, listed as read back from them."""
    return grammar.indexed(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)


@query
def op8_tokeniser_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the verdict of the fertility bands for all documents."""
    rows = fertility.ruled(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"),
                           public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), carry=["doc_id", "lang"])
    return rows.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                       "chars_per_piece", "chars_per_rank", "entropy", "script")


@query
def op2_subsequence_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents; a quarter of the labels is held out."""
    rows = subsequence.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), carry=["doc_id"])
    return rows.select("row.doc_id", (F.crc32(F.col("row.doc_id").cast("string")) % 4 == 2).alias("held_out"), "score",
                       (F.col("score") >= 0.3).cast("int").alias("predicted"), "worst")


@query
def op9_block_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return mainblocks.extracted(table(spark, sf_dir, "pages")).select("row.page_id", "row.url", "text", "n_chars")


@query
def op3_chat_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations formatted for training, as read back from the formatted text."""
    return chat.digests(chat.with_trap(table(spark, sf_dir, "conversations")))


ORACLES["op3_chat_round_trip"] = chat.ORACLE


@query
def op4_weak_label_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents, learnt from heuristic labellers alone."""
    rows = weaklabel.scored(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return rows.select("row.doc_id", "posterior", "score", (F.col("score") >= weaklabel.KEEP).alias("kept"))


@query
def op10_licence_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices in all documents: share of the template and place in the text, one row per match."""
    rows = licences.scanned(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return rows.select("row.doc_id", "n_words", F.explode("found").alias("f")).select(
        "doc_id", "n_words", "f.licence", "f.coverage", "f.matched", "f.begin_word", "f.end_word", "f.begin_char", "f.end_char")


@query
def op11_spectrum_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened scores of all embeddings on the 16 leading components."""
    rows = whitening.whitened(table(spark, sf_dir, "embeddings"), components=16, carry=["vec_id"])
    return rows.select("row.vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")


@query
def op12_merge_path_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links between the tokens of two vocabularies for all documents."""
    rows = alignment.aligned(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                             public_tokenizers.path("piece_bpe_32k.model"), carry=["doc_id"])
    return rows.select(F.col("row.doc_id").cast("bigint").alias("doc_id"), *alignment.COLUMNS, "groups_sha256")


@query
def op13_improbable_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and their likeness to an edited text and to the next document."""
    return digests.compared(table(spark, sf_dir, "documents"))
