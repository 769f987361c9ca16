"""Change-log messages in the Debezium envelope."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import schemas
from ..functions.keys import parsed_once


def parse(rows: DataFrame, value: str = "value") -> DataFrame:
    """Envelope columns of the readable change messages; `unreadable` has the others."""
    return rows.select(F.inline(parsed_once(F.from_json(value, schemas.CDC), lambda e: e["op"].isNotNull())))


def unreadable(rows: DataFrame, value: str = "value") -> DataFrame:
    """Messages without an operation: no JSON, or no change envelope."""
    return rows.filter(F.from_json(value, schemas.CDC)["op"].isNull()).select(value)


def of_table(changes: DataFrame, *tables: str) -> DataFrame:
    return changes.filter(F.col("source")["table"].isin(list(tables)))


def image() -> Column:
    """Row image a change leaves behind: `before` for a delete, else `after`."""
    return F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))


def after(*names: str) -> list[Column]:
    return [F.col("after")[n].alias(n) for n in names]


def cleaned(changes: DataFrame) -> DataFrame:
    """Only the operation and the one image that applies."""
    deleted = F.col("op") == "d"
    return changes.select("op", F.when(deleted, F.col("before")).alias("before"),
                          F.when(~deleted, F.col("after")).alias("after"))
