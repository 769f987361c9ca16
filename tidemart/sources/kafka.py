"""Topics as stream sources and sinks. Needs the Kafka connector on the classpath."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter

from ..streaming import ingest

LOAD_ROWS, LOAD_SECONDS = 300_000, 30


def source_options(servers: str, topics: Sequence[str], group: str | None = None, starting: str = "earliest",
                   max_rows: int | None = None) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers, "subscribe": ",".join(topics), "startingOffsets": starting,
               "failOnDataLoss": "true"}
    if group:
        options["kafka.group.id"] = group
    if max_rows:
        options["maxOffsetsPerTrigger"] = str(max_rows)
    return options


def read_topic(spark: SparkSession, servers: str, topics: Sequence[str], **options) -> DataFrame:
    rows = spark.readStream.format("kafka").options(**source_options(servers, topics, **options)).load()
    return as_text(rows)


def as_text(rows: DataFrame) -> DataFrame:
    """Message text with its place in the topic; empty messages become NULL and are dropped."""
    kept = [c for c in ("topic", "partition", "offset") if c in rows.columns]
    return rows.select(F.col("value").cast("string").alias("value"), *kept).filter(F.col("value").isNotNull())


def as_records(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Fields of the readable messages; `unreadable` has the others."""
    return ingest.clean(ingest.parse_records(rows, schema))


def unreadable(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Messages that are no JSON object of the schema, as they came."""
    return ingest.dirty(ingest.parse_records(rows, schema))


def to_messages(df: DataFrame, key: str | None = None) -> DataFrame:
    value = F.to_json(F.struct(*df.columns)).alias("value")
    return df.select(*([F.col(key).cast("string").alias("key")] if key else []), value)


def sink_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic, "kafka.acks": "all", "kafka.enable.idempotence": "true"}


def write_topic(df: DataFrame, servers: str, topic: str, checkpoint: str, key: str | None = None) -> DataStreamWriter:
    """Writer of a stream as JSON messages; call `.start()` on it."""
    return (to_messages(df, key).writeStream.format("kafka").options(**sink_options(servers, topic))
            .option("checkpointLocation", checkpoint))
