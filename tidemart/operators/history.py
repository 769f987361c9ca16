"""Zip tables: one row per version with a validity interval."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .ordered import in_sequence

OPEN_END = "9999-12-31"


def open_versions(snapshot: DataFrame, start: Column, open_end: str = OPEN_END) -> DataFrame:
    """First load: every row is the open version."""
    return snapshot.withColumn("start_date", start) \
        .withColumn("end_date", F.lit(open_end).cast("date"))


def merge_versions(history: DataFrame, snapshot: DataFrame, keys: Sequence[str],
                   tracked: Sequence[str], day: Column, open_end: str = OPEN_END) -> DataFrame:
    """History after a new snapshot.

    A changed row closes its open version on the day before and opens a new one; a version
    that itself started on that day is replaced. An unchanged or missing row stays as it is. Keys meet in one full outer join.
    """
    columns = [*keys, *tracked]
    end = F.lit(open_end).cast("date")
    is_open = F.col("end_date") == end
    closed = history.filter(~is_open).select(*columns, "start_date", "end_date")
    old = history.filter(is_open).select(
        *[F.col(k).alias(f"_ok_{k}") for k in keys],
        F.struct(*columns).alias("_old"), F.col("start_date").alias("_old_start"))
    new = snapshot.select(*keys, F.struct(*columns).alias("_new"))
    cond = None
    for k in keys:
        one = old[f"_ok_{k}"] == new[k]
        cond = one if cond is None else cond & one
    pair = old.join(new, cond, "full_outer")
    gone, fresh = F.col("_new").isNull(), F.col("_old").isNull()
    same = F.col("_old").eqNullSafe(F.col("_new"))
    version = lambda row, start, stop: F.struct(
        row.alias("row"), start.alias("start_date"), stop.alias("end_date"))
    rows = F.when(gone | same, F.array(version(F.col("_old"), F.col("_old_start"), end))) \
        .when(fresh, F.array(version(F.col("_new"), day, end))) \
        .when(F.col("_old_start") >= day, F.array(version(F.col("_new"), F.col("_old_start"), end))) \
        .otherwise(F.array(version(F.col("_old"), F.col("_old_start"), F.date_sub(day, 1)),
                           version(F.col("_new"), day, end)))
    current = pair.select(F.inline(rows)).select(
        *[F.col(f"row.{c}").alias(c) for c in columns], "start_date", "end_date")
    return closed.unionByName(current)


def versions_from_changes(changes: DataFrame, keys: Sequence[str], ts: str,
                          tiebreak: Sequence[str], open_end: str = OPEN_END,
                          slice_seconds: int = 86_400) -> DataFrame:
    """Whole history from a change log: the last change of a day counts, and a version ends the
    day before the next starts."""
    order = F.struct(ts, *tiebreak)
    rest = [c for c in changes.columns if c not in (*keys, ts, *tiebreak)]
    last = changes.groupBy(*keys, F.to_date(ts).alias("_day")).agg(
        F.max(F.struct(order.alias("order"), *[F.col(c) for c in rest])).alias("_last"))
    columns = [F.col(f"_last.order.{c}").alias(c) for c in (ts, *tiebreak)] + [F.col(f"_last.{c}").alias(c) for c in rest]
    walked = in_sequence(last.select(*keys, *columns), keys, ts, tiebreak, following={"_next_ts": ts},
                         slice_seconds=slice_seconds)
    return walked.select(*changes.columns, F.to_date(ts).alias("start_date"), F.coalesce(
        F.date_sub(F.to_date("_next_ts"), 1), F.lit(open_end).cast("date")).alias("end_date"))
