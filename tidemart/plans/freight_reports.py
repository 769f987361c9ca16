"""Freight reports over the last 1, 7 and 30 days and to date."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.ratios import share
from ..operators.joins import merge_metrics
from ..operators.recent import recent_long
from ..operators.sets import union_all

SPANS = (1, 7, 30)
FINISH = ["trans_finish_count", "trans_finish_distance", "trans_finish_dur_sec"]


def _spans(daily: DataFrame, as_of: Column, keys: Sequence[str], sums: dict[str, str],
           spans: Sequence[int] = SPANS) -> DataFrame:
    return recent_long(daily, "dt", as_of, spans, keys, sums)


def _same(columns: Sequence[str]) -> dict[str, str]:
    return {c: c for c in columns}


def _averages(df: DataFrame) -> DataFrame:
    count = F.col("trans_finish_count")
    return df.withColumn("avg_trans_finish_distance", share(F.col("trans_finish_distance"), count)) \
        .withColumn("avg_trans_finish_dur_sec", share(F.col("trans_finish_dur_sec"), count))


def waybill_stats(receives: DataFrame, dispatched: DataFrame, as_of: Column) -> DataFrame:
    received = _spans(receives, as_of, [], {"receive_order_count": "order_count", "receive_order_amount": "order_amount"})
    sent = _spans(dispatched, as_of, [], {"dispatch_order_count": "order_count", "dispatch_order_amount": "order_amount"})
    return merge_metrics(["recent_days"], received, sent).withColumn("dt", as_of)


def transport_stats(org_finishes: DataFrame, as_of: Column) -> DataFrame:
    return _spans(org_finishes, as_of, [], _same(FINISH)).withColumn("dt", as_of)


def waybills_on_the_way(dispatched_td: DataFrame, bound_td: DataFrame, as_of: Column) -> DataFrame:
    """Dispatched so far less arrived so far."""
    minus = bound_td.select((-F.col("order_count")).alias("order_count"),
                            (-F.col("order_amount")).cast("decimal(38,2)").alias("order_amount"))
    both = union_all(dispatched_td.select("order_count", F.col("order_amount").cast("decimal(38,2)")
                                          .alias("order_amount")), minus)
    return both.agg(F.sum("order_count").alias("bounding_order_count"),
                    F.sum("order_amount").alias("bounding_order_amount")).withColumn("dt", as_of)


def order_stats(org_orders: DataFrame, as_of: Column) -> DataFrame:
    return _spans(org_orders, as_of, [], _same(["order_count", "order_amount"])).withColumn("dt", as_of)


def cargo_type_stats(org_orders: DataFrame, as_of: Column) -> DataFrame:
    return _spans(org_orders, as_of, ["cargo_type", "cargo_type_name"],
                  _same(["order_count", "order_amount"])).withColumn("dt", as_of)


def place_stats(org_orders: DataFrame, org_finishes: DataFrame, keys: Sequence[str], as_of: Column) -> DataFrame:
    """Orders and transports side by side per city or organisation; NULL places meet too."""
    orders = _spans(org_orders, as_of, keys, _same(["order_count", "order_amount"]))
    finishes = _spans(org_finishes, as_of, keys, _same(FINISH))
    return _averages(merge_metrics([*keys, "recent_days"], orders, finishes)).withColumn("dt", as_of)


def shift_stats(shift_recent: DataFrame, as_of: Column) -> DataFrame:
    return shift_recent.groupBy("recent_days", "shift_id").agg(
        *[F.sum(c).alias(c) for c in (*FINISH, "trans_finish_order_count")]).withColumn("dt", as_of)


def line_stats(shift_recent: DataFrame, as_of: Column) -> DataFrame:
    return shift_recent.groupBy("recent_days", "line_id", "line_name").agg(
        *[F.sum(c).alias(c) for c in (*FINISH, "trans_finish_order_count")]).withColumn("dt", as_of)


def driver_stats(shift_recent: DataFrame, as_of: Column) -> DataFrame:
    """Two drivers of a transport share distance and time by halves; both count the
    transport and its late arrivals. One row in, one or two rows out, no join."""
    pair = F.col("driver2_emp_id").isNotNull()
    driver = lambda n: F.struct(F.col(f"driver{n}_emp_id").alias("driver_emp_id"),
                                F.col(f"driver{n}_name").alias("driver_name"))
    crew = F.when(pair, F.array(driver(1), driver(2))).otherwise(F.array(driver(1)))
    halves = F.when(pair, 2).otherwise(1)
    rows = shift_recent.select(
        "recent_days", F.inline(crew), "trans_finish_count",
        (F.col("trans_finish_distance").cast("decimal(20,2)") / halves).cast("decimal(22,3)").alias("trans_finish_distance"),
        (F.col("trans_finish_dur_sec").cast("decimal(20,0)") / halves).cast("decimal(21,1)").alias("trans_finish_dur_sec"),
        "trans_finish_delay_count")
    out = rows.groupBy("recent_days", "driver_emp_id", "driver_name").agg(
        *[F.sum(c).alias(c) for c in FINISH], F.sum("trans_finish_delay_count").alias("trans_finish_late_count"))
    return _averages(out).withColumn("dt", as_of)


def truck_stats(shift_recent: DataFrame, as_of: Column) -> DataFrame:
    out = shift_recent.groupBy("recent_days", "truck_model_type", "truck_model_type_name").agg(
        *[F.sum(c).alias(c) for c in FINISH])
    return _averages(out).withColumn("dt", as_of)


def express_stats(receives: DataFrame, deliveries: DataFrame, sorts: DataFrame, keys: Sequence[str],
                  as_of: Column) -> DataFrame:
    """Receives, deliveries and sorts per key; no keys gives the totals."""
    parts = [_spans(receives, as_of, keys, {"receive_order_count": "order_count", "receive_order_amount": "order_amount"}),
             _spans(deliveries, as_of, keys, {"deliver_suc_count": "order_count"}),
             _spans(sorts, as_of, keys, {"sort_count": "sort_count"})]
    return merge_metrics([*keys, "recent_days"], *parts).withColumn("dt", as_of)
