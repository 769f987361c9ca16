"""Screening of comments against a word list."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.keys import last_item

GRADE = "P0"


def screen(comments: DataFrame, words: DataFrame, text: str = "comment_txt", word: str = "word") -> DataFrame:
    """Flag comments whose last comma-separated part is a listed word. The list is a table,
    re-read for every micro-batch on a stream."""
    listed = words.select(F.col(word).alias("_listed")).distinct()
    checked = comments.withColumn("_last", last_item(F.col(text)))
    out = checked.join(listed, F.col("_last") == F.col("_listed"), "left")
    hit = F.col("_listed").isNotNull()
    return out.withColumn("is_violation", F.when(hit, 1).otherwise(0)) \
        .withColumn("violation_grade", F.when(hit, GRADE).otherwise("")) \
        .withColumn("violation_msg", F.when(hit, F.col("_last")).otherwise("")).drop("_last", "_listed")
