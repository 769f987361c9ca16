"""The daily run: layers that each read one day partition, check it, and rewrite that day."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.cleaning import live_on
from ..operators.quality import require_rows
from ..sources.tables import overwrite_days


@dataclass(frozen=True)
class Layer:
    """A day-partitioned table made from one below it."""

    name: str
    source: str
    target: str
    build: Callable[[DataFrame], DataFrame]
    day: str = "dt"


def read_day(spark: SparkSession, path: str, day: str, column: str = "dt") -> DataFrame:
    """One day's partition without logically deleted rows; no other partition is listed for reading."""
    rows = spark.read.parquet(path)
    return rows.filter(live_on(column, day) if "is_deleted" in rows.columns else F.col(column) == F.lit(day))


def run_day(spark: SparkSession, layers: Sequence[Layer], day: str) -> None:
    """Builds the day's partition of each layer in turn; a day without rows below stops the run.

    A layer rewrites its own day only, so a day that runs again gives the same tables.
    """
    for layer in layers:
        rows = require_rows(read_day(spark, layer.source, day, layer.day), f"{layer.name} on {day}")
        overwrite_days(layer.build(rows).withColumn(layer.day, F.lit(day).cast("date")), layer.target, layer.day)


def recent_days(spark: SparkSession, path: str, as_of: str, days: int, column: str = "dt") -> DataFrame:
    """The partitions of the last `days` days up to `as_of`, chosen by their names."""
    last = F.to_date(F.lit(as_of))
    return spark.read.parquet(path).filter((F.col(column) <= last) & (F.col(column) > F.date_sub(last, days)))
