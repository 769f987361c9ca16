"""Quality figures taken in passing, while a layer is written.

The figures are observed in the stage that writes, where each partition counts once even if a task or a
stage runs again. No layer is read a second time for its checks.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from .quality import EmptyLayer

ROWS = "row_count"
SCHEMA = "layer string, measure string, value double"


def nulls(*columns: str) -> dict[str, Column]:
    return {f"{c}_nulls": F.count_if(F.col(c).isNull()) for c in columns}


def bounds(*columns: str) -> dict[str, Column]:
    """Least and greatest value as doubles; both None without a value."""
    return {f"{c}_{name}": fn(F.col(c).cast("double")) for c in columns for name, fn in (("min", F.min), ("max", F.max))}


def write_measured(df: DataFrame, path: str, day: str = "dt", measures: Mapping[str, Column] | None = None) -> dict[str, float | None]:
    """Rewrite the days that `df` has and return its row count and measures, from the same job."""
    seen = Observation()
    parts = [F.count(F.lit(1)).alias(ROWS), *[col.alias(name) for name, col in (measures or {}).items()]]
    (df.hint("rebalance", day).observe(seen, *parts).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path))
    return dict(seen.get)


def require_written(figures: Mapping[str, float | None], name: str) -> None:
    """Gate on the figures of the layer below: nothing is read."""
    if not figures[ROWS]:
        raise EmptyLayer(f"{name} has no rows")


def as_rows(spark: SparkSession, layers: Mapping[str, Mapping[str, float | None]]) -> DataFrame:
    """One row per layer and measure; a measure without a value is NULL."""
    rows = [(layer, name, None if value is None else float(value)) for layer, figures in layers.items() for name, value in figures.items()]
    return spark.createDataFrame(rows, SCHEMA)


def disagreements(figures: Mapping[str, Mapping[str, float | None]], expected: Mapping[tuple[str, str], tuple[str, str]]) -> list[str]:
    """Pairs (layer, measure) that should hold the same figure and don't, as text."""
    out = []
    for (layer, name), (other, other_name) in expected.items():
        a, b = figures[layer][name], figures[other][other_name]
        if a != b:
            out.append(f"{layer}.{name} is {a}, {other}.{other_name} is {b}")
    return out
