"""Data-quality profile, layer gates and reconciliation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F


class EmptyLayer(RuntimeError):
    """A source day has no rows, so the layer above must not be built."""


def profile(df: DataFrame, numeric: Sequence[str] = (), pair: Sequence[str] = ()) -> DataFrame:
    """One row: row count, distinct key pairs, and count/min/avg/max per numeric column."""
    parts = [F.count(F.lit(1)).alias("row_count")]
    for name in numeric:
        value = F.col(name).cast("double")
        parts += [F.count(value).alias(f"{name}_count"), F.min(value).alias(f"{name}_min"),
                  (F.sum(F.col(name).cast("decimal(38,4)")).cast("double") / F.count(value))
                  .alias(f"{name}_avg"),
                  F.max(value).alias(f"{name}_max")]
    if pair:
        parts.append(F.count_distinct(F.struct(*pair)).alias("pair_count")
                     if len(pair) == 1 else
                     F.count_distinct(*[F.col(c) for c in pair]).alias("pair_count"))
    return df.agg(*parts)


def distribution(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(F.col(column).cast("string").alias("value")) \
        .agg(F.count(F.lit(1)).alias("row_count")) \
        .select(F.lit(column).alias("column_name"), "value", "row_count")


def require_rows(df: DataFrame, name: str) -> DataFrame:
    """Gate: stop when a source is empty. Reads until the first row only."""
    if df.isEmpty():
        raise EmptyLayer(f"{name} has no rows")
    return df


def row_counts(layers: Mapping[str, DataFrame]) -> DataFrame:
    counts = [df.agg(F.count(F.lit(1)).alias("row_count"))
              .select(F.lit(name).alias("layer"), "row_count") for name, df in layers.items()]
    return reduce(DataFrame.unionByName, counts)


def reconcile(lower: DataFrame, upper: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row counts of two layers per key, and whether they agree."""
    sides = [df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
             .select(*keys, *[(F.col("n") if s == i else F.lit(0)).alias(c)
                              for s, c in enumerate(("lower_rows", "upper_rows"))])
             for i, df in enumerate((lower, upper))]
    both = sides[0].unionByName(sides[1]).groupBy(*keys).agg(
        F.sum("lower_rows").alias("lower_rows"), F.sum("upper_rows").alias("upper_rows"))
    return both.withColumn("is_equal", (F.col("lower_rows") == F.col("upper_rows")).cast("int"))
