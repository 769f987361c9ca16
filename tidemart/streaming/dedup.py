"""Duplicate filters over streams."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F

from ..sources.upsert import UpsertTable


def exact(stream: DataFrame, keys: Sequence[str], payload: Sequence[str] | None = None) -> DataFrame:
    """Drop rows whose key and content came before within the watermark. The content is part
    of the state key, so a busy key spreads over all state partitions."""
    content = list(payload or [c for c in stream.columns if c not in keys])
    return stream.dropDuplicatesWithinWatermark([*keys, *content])


def newer_only_batch(df: DataFrame, keys: Sequence[str], time: str, arrival: str,
                     slice_rows: int = 1_000_000) -> DataFrame:
    """Batch form of `newer_only`: rows newer than every earlier arrival of their key."""
    from ..operators.ordered import newest_before

    seen = newest_before(df, keys, arrival, time, "_seen", slice_rows=slice_rows)
    return seen.filter(F.col("_seen").isNull() | (F.col(time) > F.col("_seen"))).drop("_seen")


def newer_only_step(store: UpsertTable, out: str, key: str, time: str, arrival: str,
                    slice_rows: int = 1_000_000) -> Callable[[DataFrame, int], None]:
    """Micro-batch step: writes the rows newer than all earlier arrivals of their key to `out`.

    `store` has the newest time per key (columns: key, time). Batches before the running one
    are the only ones read, so a repeated batch gives the same rows; with a retention, keys
    whose newest time is older than that are forgotten.
    """
    from ..operators.ordered import newest_before

    def step(batch: DataFrame, batch_id: int) -> None:
        newest = batch.agg(F.max(time)).first()[0] if store.retention_ms is not None else None
        known = store.before(batch_id, newest).select(F.col(key).alias("_k"), F.col(time).alias("_known"))
        seen = newest_before(batch, [key], arrival, time, "_seen", slice_rows=slice_rows)
        seen = seen.join(known, seen[key].eqNullSafe(known["_k"]), "left").withColumn("_seen", F.greatest("_seen", "_known"))
        kept = seen.filter(F.col("_seen").isNull() | (F.col(time) > F.col("_seen"))).select(*batch.columns)
        kept.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
        store.upsert(batch.groupBy(key).agg(F.max(time).alias(time)), batch_id)

    return step
