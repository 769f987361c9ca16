"""Ordered work inside a key that may hold a large part of all rows.

A plain `lead`/`row_number` window sorts a whole key in one task. Here each key
is cut into time slices. Windows run per (key, slice); one summary row per
slice carries the missing link to the neighbouring slices. The result equals
the plain window exactly, but a hot key spreads over as many tasks as it has
slices.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import Window as W

from ..session import cut_lineage

SLICE = "_slice"


def time_slice(ts: Column, seconds: int) -> Column:
    return F.floor(F.unix_seconds(ts) / seconds)


def _null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join in which NULL keys meet; right keys are dropped."""
    renamed = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                           *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        one = left[k].eqNullSafe(renamed[f"_r_{k}"])
        cond = one if cond is None else cond & one
    return left.join(renamed, cond, how).drop(*[f"_r_{k}" for k in keys])


def in_sequence(df: DataFrame, keys: Sequence[str], ts: str, tiebreak: Sequence[str], *,
                step: str | None = None, following: Mapping[str, str] | None = None,
                slice_seconds: int = 3600) -> DataFrame:
    """Add the row's step number and values of the row that follows it.

    Rows of a key are ordered by `ts`, then `tiebreak`, then the followed columns, so rows that
    are equal in the order are equal in what is taken from them. `following` maps an output
    column to the column whose next value it takes. The numbered rows are written once; the
    links between slices are made from them, so both see one order and one input.
    """
    following = dict(following or {})
    keys, order = list(keys), list(dict.fromkeys([ts, *tiebreak, *following.values()]))
    by_slice = W.partitionBy(*keys, SLICE).orderBy(*order)
    along = W.partitionBy(*keys).orderBy(SLICE)
    sources = list(dict.fromkeys(following.values()))
    values = F.struct(F.lit(1).alias("v"), *[F.col(c).alias(f"v{i}") for i, c in enumerate(sources)])
    work = df.withColumn(SLICE, time_slice(F.col(ts), slice_seconds)).withColumn("_row", F.row_number().over(by_slice))
    if following:
        work = work.withColumn("_next_here", F.lead(values).over(by_slice))
    work = cut_lineage(work, "sequence")
    summary = work.groupBy(*keys, SLICE).agg(
        F.max("_row").alias("_rows"), F.min(F.when(F.col("_row") == 1, values)).alias("_first"))
    links = summary.select(
        *keys, SLICE,
        F.coalesce(F.sum("_rows").over(along.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.lead("_first").over(along).alias("_next_first"))
    joined = _null_safe(work, links, [*keys, SLICE], "inner")
    if step:
        joined = joined.withColumn(step, (F.col("_row") + F.col("_before")).cast("bigint"))
    for out, source in following.items():
        i = sources.index(source)
        joined = joined.withColumn(out, F.when(
            F.col("_next_here").isNotNull(), F.col(f"_next_here.v{i}")
        ).otherwise(F.col(f"_next_first.v{i}")))
    return joined.drop(SLICE, "_row", "_before", "_next_first", *(["_next_here"] if following else []))


def newest_before(df: DataFrame, keys: Sequence[str], arrival: str, value: str, out: str, *,
                  slice_rows: int = 1_000_000) -> DataFrame:
    """Greatest `value` among the rows of the key that arrived earlier.

    `arrival` is a whole number that orders the rows; slices are ranges of it.
    """
    keys = list(keys)
    sliced = df.withColumn(SLICE, F.floor(F.col(arrival) / slice_rows))
    here = W.partitionBy(*keys, SLICE).orderBy(arrival).rowsBetween(W.unboundedPreceding, -1)
    along = W.partitionBy(*keys).orderBy(SLICE).rowsBetween(W.unboundedPreceding, -1)
    links = (sliced.groupBy(*keys, SLICE).agg(F.max(value).alias("_top"))
             .select(*keys, SLICE, F.max("_top").over(along).alias("_top_before")))
    work = sliced.withColumn("_top_here", F.max(value).over(here))
    joined = _null_safe(work, links, [*keys, SLICE], "inner")
    return joined.withColumn(out, F.greatest("_top_here", "_top_before")) \
        .drop(SLICE, "_top_here", "_top_before")
