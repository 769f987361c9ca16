"""User profiles from page logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.keys import first_word

ATTRIBUTES = ("os", "ch", "md", "ba", "search_item")


def device_and_search(logs: DataFrame) -> DataFrame:
    """One row per log record: user, device parts, and the search word of a keyword page."""
    word = F.when(F.col("page.item_type") == "keyword", F.col("page.item"))
    return logs.filter(F.col("common").isNotNull()).select(
        F.coalesce("common.uid", F.lit("-1")).alias("uid"), F.col("ts"),
        first_word(F.col("common.os")).alias("os"), F.col("common.ch").alias("ch"), F.col("common.md").alias("md"),
        F.col("common.ba").alias("ba"), F.col("common.ar").alias("ar"), F.col("common.vc").alias("vc"),
        word.alias("search_item"))


def known_users(devices: DataFrame) -> DataFrame:
    return devices.filter(F.col("uid") != "-1")


def attribute_counts(devices: DataFrame) -> DataFrame:
    """Running counts per user, attribute and value: state that grows with distinct values
    only and in which a busy user is spread over its values."""
    pairs = F.array(F.struct(F.lit("pv").alias("attribute"), F.lit("").alias("value")),
                    *[F.struct(F.lit(a).alias("attribute"), F.col(a).alias("value")) for a in ATTRIBUTES])
    long = devices.select("uid", "ts", F.inline(pairs)).filter(F.col("value").isNotNull())
    return long.groupBy("uid", "attribute", "value").agg(F.count(F.lit(1)).alias("n"), F.max("ts").alias("last_ts"))


def profile_rows(counts: DataFrame) -> DataFrame:
    """One profile per user from attribute counts: page views, value sets as text, last search."""
    def values(attribute):
        hit = F.when(F.col("attribute") == attribute, F.col("value"))
        return F.array_join(F.array_sort(F.collect_set(hit)), ",").alias(attribute)

    searched = F.when(F.col("attribute") == "search_item", F.struct("last_ts", "value"))
    return counts.groupBy("uid").agg(
        F.sum(F.when(F.col("attribute") == "pv", F.col("n"))).alias("pv"), *[values(a) for a in ATTRIBUTES],
        F.max(searched).getField("value").alias("last_search"), F.max("last_ts").alias("ts_ms"))


def last_per_window(rows: DataFrame, key: str, time: str, width: str = "2 minutes") -> DataFrame:
    """Last row of each key in each tumbling window (needs a watermark on a stream)."""
    others = [c for c in rows.columns if c not in (key, time)]
    latest = rows.groupBy(key, F.window(time, width).alias("_w")).agg(
        F.max(F.struct(time, *others)).alias("_last"))
    return latest.select(key, F.col("_w.start").alias("window_start"), "_last.*")
