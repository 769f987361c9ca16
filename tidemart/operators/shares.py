"""Totals and shares of a whole table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.ratios import percent


def with_total_share(df: DataFrame, value: str, out: str, digits: int = 2) -> DataFrame:
    """Percent of the table total; the total is one scalar subquery."""
    total = df.agg(F.sum(value)).scalar()
    return df.withColumn(out, percent(F.col(value), total, digits))


def scalar_row(df: DataFrame, metrics: Mapping[str, Column]) -> DataFrame:
    """Several scalar metrics of one table in one pass by conditional aggregation."""
    return df.agg(*[col.alias(name) for name, col in metrics.items()])
