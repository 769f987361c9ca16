"""Totals over the last n days, in long and wide form."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.timekeys import within_recent


def recent_long(daily: DataFrame, day: str, as_of: Column, spans: Sequence[int],
                keys: Sequence[str], sums: Mapping[str, str]) -> DataFrame:
    """One row per key and span. Feed it daily sums: rows older than the longest
    span are pruned first, so a row is copied at most once per span."""
    recent = daily.filter(within_recent(F.col(day), as_of, max(spans)))
    fitting = F.filter(F.array(*[F.lit(n).cast("bigint") for n in spans]),
                       lambda n: F.datediff(as_of, F.col(day)) < n)
    copies = recent.withColumn("recent_days", F.explode(fitting))
    return copies.groupBy(*keys, "recent_days").agg(
        *[F.sum(src).alias(out) for out, src in sums.items()])


def recent_sums(day: str, as_of: Column, spans: Sequence[int],
                sums: Mapping[str, str]) -> list[Column]:
    """Aggregates for the wide form: `<out>_<n>d` per span, no copied rows."""
    out = []
    for n in spans:
        inside = within_recent(F.col(day), as_of, n)
        out += [F.coalesce(F.sum(F.when(inside, F.col(src))), F.lit(0)).alias(f"{name}_{n}d")
                for name, src in sums.items()]
    return out


def recent_wide(daily: DataFrame, day: str, as_of: Column, spans: Sequence[int],
                keys: Sequence[str], sums: Mapping[str, str]) -> DataFrame:
    recent = daily.filter(within_recent(F.col(day), as_of, max(spans)))
    return recent.groupBy(*keys).agg(*recent_sums(day, as_of, spans, sums))


def span_rows(wide: DataFrame, keys: Sequence[str], spans: Sequence[int],
              metrics: Sequence[str]) -> DataFrame:
    """Turn `<metric>_<n>d` columns into one row per span without a second pass."""
    per_span = F.array(*[
        F.struct(F.lit(n).cast("bigint").alias("recent_days"),
                 *[F.col(f"{m}_{n}d").alias(m) for m in metrics]) for n in spans])
    return wide.select(*keys, F.inline(per_span))


def last_seen_counts(df: DataFrame, keys: Sequence[str], member: str, day: str, as_of: Column,
                     spans: Sequence[int], out: str) -> DataFrame:
    """Distinct members per key in each span from one pass.

    A member belongs to a span exactly if the member's last day does, so one row
    per (key, member) answers every span; no row is copied, no distinct is needed.
    """
    recent = df.filter(within_recent(F.col(day), as_of, max(spans)) & F.col(member).isNotNull())
    last = recent.groupBy(*keys, member).agg(F.max(day).alias("_last"))
    return last.groupBy(*keys).agg(*[
        F.count(F.when(within_recent(F.col("_last"), as_of, n), 1)).alias(f"{out}_{n}d")
        for n in spans])
