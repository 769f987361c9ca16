"""Parsing of log and change messages with a branch for bad rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from .. import schemas
from ..functions.keys import parsed_once
from ..functions.timekeys import from_millis

LOG_DELAY, CHANGE_DELAY = "3 seconds", "5 seconds"


def parse_records(rows: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Keep the text and add `rec`; a text that is no JSON object of the schema has a NULL `rec`."""
    probe = F.from_json(value, T.StructType([*schema.fields, T.StructField("_bad", T.StringType())]),
                        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    return rows.withColumn("_rec", probe).withColumn(
        "rec", F.when(F.col("_rec").isNotNull() & F.col("_rec._bad").isNull(),
                      F.struct(*[F.col(f"_rec.{f.name}").alias(f.name) for f in schema.fields]))).drop("_rec")


def clean(parsed: DataFrame) -> DataFrame:
    return parsed.select(F.inline(parsed_once(F.col("rec"), lambda r: r.isNotNull())))


def dirty(parsed: DataFrame, value: str = "value") -> DataFrame:
    return parsed.filter(F.col("rec").isNull()).select(value)


def page_logs(rows: DataFrame, value: str = "value") -> DataFrame:
    return clean(parse_records(rows, schemas.PAGE_LOG, value))


def with_event_time(df: DataFrame, millis: str, delay: str, out: str = "et") -> DataFrame:
    """Event time with a watermark. Rows without a usable time are not given time 0: they
    are left out here and found by `without_event_time`."""
    timed = df.withColumn(out, from_millis(F.col(millis).cast("string"))).filter(F.col(out).isNotNull())
    return timed.withWatermark(out, delay)


def without_event_time(df: DataFrame, millis: str) -> DataFrame:
    return df.filter(from_millis(F.col(millis).cast("string")).isNull())
