"""Top-k and full rankings that never sort everything in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import Window as W

from ..session import cut_lineage

_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int,
                  out: str = "rk", ties: bool = True) -> DataFrame:
    """Best `k` ranks per group. Spark limits each task's groups before the
    shuffle (WindowGroupLimit), so a hot group sends at most k ranks per task."""
    fn = F.rank() if ties else F.row_number()
    ranked = df.withColumn(out, fn.over(W.partitionBy(*group).orderBy(*order)))
    return ranked.filter(F.col(out) <= k).withColumn(out, F.col(out).cast("bigint"))


def top_overall(df: DataFrame, order: Sequence[Column], k: int, out: str = "rank_num") -> DataFrame:
    """First `k` rows with their position; `order` must be total.

    The limit is a distributed top-k, and only its k rows are numbered.
    """
    best = df.orderBy(*order).limit(k)
    return best.withColumn(out, F.row_number().over(W.orderBy(*order)).cast("bigint"))


def numbered(df: DataFrame, order: Sequence[Column], out: str) -> DataFrame:
    """Position of every row in the total order `order` over the whole input.

    The range sort spreads the rows; the sorted layout is written once so that
    partition sizes and row positions come from the same files even if tasks
    are repeated. Only one row per sort partition is needed for the offsets.
    """
    placed = cut_lineage(
        df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_at", _ROW_BITS)
    row = F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    offsets = sizes.select("_part", F.coalesce(
        F.sum("_rows").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)),
        F.lit(0)).alias("_before"))
    return (placed.withColumn("_part", part).withColumn("_row", row)
            .join(offsets, "_part")
            .withColumn(out, F.col("_before") + F.col("_row") + 1)
            .drop("_at", "_part", "_row", "_before"))


def ranked(df: DataFrame, value: str, tiebreak: Sequence[str], out: str,
           descending: bool = True) -> DataFrame:
    """SQL `rank()` over the whole input: equal values share the lowest position."""
    first = F.col(value).desc() if descending else F.col(value).asc()
    placed = numbered(df, [first, *[F.col(c) for c in tiebreak]], "_pos")
    best = placed.groupBy(value).agg(F.min("_pos").alias(out))
    if out in placed.columns:
        raise ValueError(f"column {out} exists already")
    ranks = best.withColumnRenamed(value, "_value")
    return placed.join(ranks, placed[value].eqNullSafe(ranks["_value"])).drop("_value", "_pos")


def numbered_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column],
                       out: str) -> DataFrame:
    """row_number per group: overall positions minus the position where the group starts."""
    placed = numbered(df, [*[F.col(g).asc_nulls_first() for g in group], *order], "_pos")
    starts = placed.groupBy(*group).agg((F.min("_pos") - 1).alias("_start"))
    renamed = starts.select(*[F.col(g).alias(f"_g_{g}") for g in group], "_start")
    cond = None
    for g in group:
        one = placed[g].eqNullSafe(renamed[f"_g_{g}"])
        cond = one if cond is None else cond & one
    return (placed.join(renamed, cond).withColumn(out, F.col("_pos") - F.col("_start"))
            .drop("_pos", "_start", *[f"_g_{g}" for g in group]))
