"""Registration of queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..bridge.sql import with_inputs
from ..bridge.tables import Inputs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Result columns as text, whole numbers and doubles, the same in every engine."""
    out = []
    for field in df.schema.fields:
        col, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, T.DecimalType):
            col = col.cast("double")
        elif isinstance(kind, (T.IntegerType, T.ShortType, T.ByteType, T.BooleanType)):
            col = col.cast("bigint")
        elif isinstance(kind, T.DateType):
            col = F.date_format(col, "yyyy-MM-dd")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            col = F.date_format(col, "yyyy-MM-dd HH:mm:ss")
        out.append(col.alias(field.name))
    return df.select(*out)


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[Inputs], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, folder: plain(fn(Inputs(spark, folder)))
        if sql is not None:
            ORACLES[name] = with_inputs(sql)
        return fn
    return register
