"""Dimension tables kept in step with a change log under a live routing table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .. import schemas
from ..functions.keys import row_key
from ..sources.upsert import DAY_MS, UpsertTable
from ..sources.versions import VERSION, Pins, VersionedTable

ROUTED = T.StructType([
    T.StructField("sink_table", T.StringType()), T.StructField("row_key", T.StringType()),
    T.StructField("info", schemas.STRING_MAP), T.StructField("ts_ms", T.LongType())])


def current_routes(config_changes: DataFrame) -> DataFrame:
    """Routing rows in force: the newest change per source table, without deleted ones.
    Columns of the input: those of a routing row, its `op`, and `ts_ms`."""
    newest = config_changes.groupBy("source_table").agg(
        F.max_by(F.struct("op", "sink_table", "sink_columns", "sink_row_key"), "ts_ms").alias("_c"))
    return newest.select("source_table", "_c.*").filter(F.col("op") != "d").drop("op")


def route(changes: DataFrame, routes: DataFrame, *more: str) -> DataFrame:
    """Changes of routed tables as dimension rows: sink table, hashed key, wanted columns, and `more` columns of the route.

    Deletes are not carried over. The routing table has one row per source table, so it is the side to broadcast.
    Without the hint Spark may send the changes, whose size it takes for that of the texts they were parsed from,
    or deal them out by their table.
    """
    kept = changes.filter(F.col("op") != "d").withColumn("_table", F.col("source")["table"])
    joined = kept.join(F.broadcast(routes), kept["_table"] == routes["source_table"])
    wanted = F.split("sink_columns", ",")
    info = F.map_filter("after", lambda k, v: F.array_contains(wanted, k))
    key = F.try_element_at(F.col("after"), F.col("sink_row_key"))
    return joined.select("sink_table", row_key(key).alias("row_key"), info.alias("info"), "ts_ms", *more)


def dimension_store(spark: SparkSession, path: str, slice_ms: int = DAY_MS) -> UpsertTable:
    return UpsertTable(spark, path, ROUTED, ["sink_table", "row_key"], slice_ms=slice_ms)


def sync_step(store: UpsertTable, read_routes: Callable[[], DataFrame]) -> Callable[[DataFrame, int], None]:
    """Step for `runner.per_batch`: routes are read again for every batch."""
    def step(batch: DataFrame, batch_id: int) -> None:
        store.upsert(route(batch, read_routes()), batch_id)
    return step


# ---- routes that change while the stream runs ------------------------------------------------

LIVE = T.StructType([*ROUTED.fields, T.StructField("route_version", T.LongType())])


def route_table(spark: SparkSession, path: str) -> VersionedTable:
    """Routing rows by source table, one version per batch of the config stream."""
    return VersionedTable(spark, path, T.StructType([*schemas.DIM_CONFIG.fields, T.StructField("ts_ms", T.LongType())]),
                          ["source_table"], order="ts_ms")


def config_step(routes: VersionedTable) -> Callable[[DataFrame, int], None]:
    """Step of the config stream: a batch of config changes becomes the next version of the routes."""
    return lambda changes, batch_id: routes.apply(changes, batch_id)


def live_store(spark: SparkSession, path: str, slice_ms: int = DAY_MS) -> UpsertTable:
    return UpsertTable(spark, path, LIVE, ["sink_table", "row_key", "route_version"], slice_ms=slice_ms)


def live_sync_step(store: UpsertTable, routes: VersionedTable, pins: Pins) -> Callable[[DataFrame, int], None]:
    """Step of the change stream: rows are routed by the version in force when their batch starts, noted so that a
    repeated batch is routed alike. A routed row carries the version that set its route."""
    def step(batch: DataFrame, batch_id: int) -> None:
        version, _ = pins.pin(batch_id, routes.newest)
        in_force = routes.at(version).withColumnRenamed("ts_ms", "_route_ms")
        store.upsert(route(batch, in_force, VERSION).withColumnRenamed(VERSION, "route_version"), batch_id)
    return step


def live_rows(store: UpsertTable, routes: VersionedTable, version: int | None = None) -> DataFrame:
    """Current rows of the sink tables that exist. A route that is deleted takes its sink table with it, and one that is
    changed starts an empty one, as rows of an older route version no longer belong to any route."""
    in_force = routes.at(routes.newest() if version is None else version)
    alive = in_force.select(F.col("sink_table").alias("_sink"), F.col(VERSION).alias("_version"))
    rows = store.latest()
    return rows.join(alive, (F.col("sink_table") == F.col("_sink")) & (F.col("route_version") == F.col("_version")), "left_semi").drop("route_version")
