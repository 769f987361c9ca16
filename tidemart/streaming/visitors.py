"""Repair of the new-visitor flag."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from ..sources.upsert import UpsertTable

DAY_MS = 86_400_000


def repair_is_new_batch(logs: DataFrame) -> DataFrame:
    """Columns mid, ts, is_new: a device counts as new only on the day of its first visit.

    If the first row of a device already says "not new", the device was known before, so
    its first day is taken as the day before. First days are one aggregated row per device.
    """
    days = first_days(logs).select(F.col("mid").alias("_mid"), F.col("first_day").alias("_start"))
    joined = logs.join(days, logs["mid"] == days["_mid"], "left")
    stale = (F.col("is_new") == "1") & (F.floor(F.col("ts") / DAY_MS) != F.col("_start"))
    return joined.withColumn("is_new", F.when(stale, "0").otherwise(F.col("is_new"))).drop("_mid", "_start")


def first_days(logs: DataFrame) -> DataFrame:
    """mid, first_day and last_ts of each device, from its earliest row."""
    first = logs.groupBy("mid").agg(F.min(F.struct("ts", "is_new")).alias("_f"), F.max("ts").alias("last_ts"))
    start = F.floor(F.col("_f.ts") / DAY_MS) - F.when(F.col("_f.is_new") == "1", 0).otherwise(1)
    return first.select("mid", start.alias("first_day"), "last_ts")


def repair_is_new_step(store: UpsertTable, out: str) -> Callable[[DataFrame, int], None]:
    """Micro-batch step of the same rule; `store` has first_day and last_ts per device.

    A device met in an earlier batch keeps its first day. Only batches before the running one
    are read, so a repeated batch gives the same rows; with a retention, devices idle for longer
    are forgotten.
    """
    def step(batch: DataFrame, batch_id: int) -> None:
        newest = batch.agg(F.max("ts")).first()[0] if store.retention_ms is not None else None
        known = store.before(batch_id, newest).select(F.col("mid").alias("_mid"), F.col("first_day").alias("_known"))
        here = first_days(batch)
        days = here.join(known, here["mid"].eqNullSafe(known["_mid"]), "left").select(
            "mid", F.coalesce("_known", "first_day").alias("first_day"), "last_ts")
        seeds = days.select(F.col("mid").alias("_mid"), F.col("first_day").alias("_start"))
        joined = batch.join(seeds, batch["mid"].eqNullSafe(seeds["_mid"]), "left")
        stale = (F.col("is_new") == "1") & (F.floor(F.col("ts") / DAY_MS) != F.col("_start"))
        joined.withColumn("is_new", F.when(stale, "0").otherwise(F.col("is_new"))).select(*batch.columns) \
            .write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
        store.upsert(days, batch_id)

    return step
