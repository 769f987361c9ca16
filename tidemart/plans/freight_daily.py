"""Freight summaries: facts shrink to place or organisation level before names join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.joins import attach, climb
from ..operators.recent import recent_long

PLACE = ["org_id", "org_name", "city_id", "city_name", "province_id", "province_name"]


def order_amounts(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Order grain from cargo grain: one amount per order, then count and sum per key."""
    per_order = rows.groupBy("order_id", *keys).agg(F.max("amount").alias("_amount"))
    return per_order.groupBy(*keys).agg(F.count("order_id").alias("order_count"),
                                        F.sum("_amount").alias("order_amount"))


def _station(by_district: DataFrame, district: str, organs: DataFrame, regions: DataFrame) -> DataFrame:
    """Organisation of a district, then city and province above it."""
    out = attach(by_district, organs, district, "region_id",
                 {"org_id": "id", "org_name": "org_name", "_region": "region_id"})
    return climb(out, regions, "_region", ["district", "city", "province"])


def org_cargo_orders(order_rows: DataFrame, organs: DataFrame, regions: DataFrame, dictionary: DataFrame) -> DataFrame:
    keys = ["cargo_type", "sender_district_id", "sender_city_id", "dt"]
    placed = attach(order_amounts(order_rows, keys), organs, "sender_district_id", "region_id",
                    {"org_id": "id", "org_name": "org_name"})
    out = placed.groupBy("org_id", "org_name", "cargo_type", F.col("sender_city_id").alias("city_id"), "dt").agg(
        F.sum("order_count").alias("order_count"), F.sum("order_amount").alias("order_amount"))
    out = attach(out, regions, "city_id", "id", {"city_name": "name"})
    names = dictionary.select(F.col("id").cast("string").alias("id"), "name")
    return attach(out, names, "cargo_type", "id", {"cargo_type_name": "name"})


def org_receives(receive_rows: DataFrame, organs: DataFrame, regions: DataFrame) -> DataFrame:
    by_district = order_amounts(receive_rows, ["sender_district_id", "dt"])
    return _station(by_district, "sender_district_id", organs, regions).groupBy(*PLACE, "dt").agg(
        F.sum("order_count").alias("order_count"), F.sum("order_amount").alias("order_amount"))


def dispatches(dispatch_rows: DataFrame) -> DataFrame:
    return order_amounts(dispatch_rows, ["dt"])


def org_truck_finishes(finishes: DataFrame, organs: DataFrame, trucks: DataFrame) -> DataFrame:
    by_truck = finishes.groupBy("start_org_id", "truck_id", "dt").agg(
        F.count("id").alias("trans_finish_count"), F.sum("actual_distance").alias("trans_finish_distance"),
        F.sum("finish_dur_sec").alias("trans_finish_dur_sec"))
    out = attach(by_truck, trucks, "truck_id", "id", ["truck_model_type", "truck_model_type_name"])
    sums = ["trans_finish_count", "trans_finish_distance", "trans_finish_dur_sec"]
    out = out.groupBy(F.col("start_org_id").alias("org_id"), "truck_model_type", "truck_model_type_name", "dt").agg(
        *[F.sum(c).alias(c) for c in sums])
    return attach(out, organs, "org_id", "id", ["org_name"])


def org_deliveries(deliver_rows: DataFrame, organs: DataFrame, regions: DataFrame) -> DataFrame:
    orders = deliver_rows.select("order_id", "receiver_district_id", "dt").distinct()
    by_district = orders.groupBy("receiver_district_id", "dt").agg(F.count("order_id").alias("order_count"))
    return _station(by_district, "receiver_district_id", organs, regions).groupBy(*PLACE, "dt").agg(
        F.sum("order_count").alias("order_count"))


def org_places(organs: DataFrame, regions: DataFrame) -> DataFrame:
    """City and province of every organisation. A level-1 organisation sits in a
    city, any other in a district, so the names come from different tree levels."""
    out = climb(organs.select("id", "org_name", "org_level", "region_id"), regions, "region_id", ["l1", "l2", "l3"])
    top = F.col("org_level") == 1
    pick = lambda at_city, at_district: F.when(top, F.col(at_city)).otherwise(F.col(at_district))
    return out.select("id", "org_name", pick("l1_id", "l2_id").alias("city_id"),
                      pick("l1_name", "l2_name").alias("city_name"), pick("l2_id", "l3_id").alias("province_id"),
                      pick("l2_name", "l3_name").alias("province_name"))


def org_sorts(sorts: DataFrame, organs: DataFrame, regions: DataFrame) -> DataFrame:
    """Sorted parcels per organisation with its place names."""
    counts = sorts.groupBy("org_id", "dt").agg(F.count(F.lit(1)).alias("sort_count"))
    return attach(counts, org_places(organs, regions), "org_id", "id", PLACE[1:])


ORDER_SUMS = {"order_count": "order_count", "order_amount": "order_amount"}


def org_cargo_orders_recent(daily: DataFrame, as_of: Column, spans=(7, 30)) -> DataFrame:
    return recent_long(daily, "dt", as_of, spans,
                       ["org_id", "org_name", "city_id", "city_name", "cargo_type", "cargo_type_name"], ORDER_SUMS)


def org_receives_recent(daily: DataFrame, as_of: Column, spans=(7, 30)) -> DataFrame:
    return recent_long(daily, "dt", as_of, spans, PLACE, ORDER_SUMS)


def dispatches_recent(daily: DataFrame, as_of: Column, spans=(7, 30)) -> DataFrame:
    return recent_long(daily, "dt", as_of, spans, [], ORDER_SUMS)


def org_deliveries_recent(daily: DataFrame, as_of: Column, spans=(7, 30)) -> DataFrame:
    return recent_long(daily, "dt", as_of, spans, PLACE, {"order_count": "order_count"})


def org_sorts_recent(daily: DataFrame, as_of: Column, spans=(7, 30)) -> DataFrame:
    return recent_long(daily, "dt", as_of, spans, PLACE, {"sort_count": "sort_count"})


SHIFT_SUMS = {"trans_finish_count": "_n", "trans_finish_distance": "actual_distance",
              "trans_finish_dur_sec": "finish_dur_sec", "trans_finish_order_count": "order_num",
              "trans_finish_delay_count": "_late"}


def shift_finishes_recent(finishes: DataFrame, organs: DataFrame, regions: DataFrame, shifts: DataFrame,
                          trucks: DataFrame, as_of: Column, spans=(7, 30)) -> DataFrame:
    """Finished transports per shift, crew and truck over recent days, with late arrivals."""
    keys = ["shift_id", "line_id", "truck_id", "start_org_id", "driver1_emp_id", "driver1_name", "driver2_emp_id",
            "driver2_name"]
    late = F.coalesce((F.col("actual_end_time") > F.col("estimate_end_time")).cast("int"), F.lit(0))
    daily = finishes.withColumn("_n", F.lit(1)).withColumn("_late", late).groupBy(*keys, "dt").agg(
        *[F.sum(c).alias(c) for c in SHIFT_SUMS.values()])
    out = recent_long(daily, "dt", as_of, spans, keys, SHIFT_SUMS).withColumnRenamed("start_org_id", "org_id")
    out = attach(out, org_places(organs, regions), "org_id", "id", ["org_name", "city_id", "city_name"])
    out = attach(out, shifts, "shift_id", "id", ["line_name"])
    out = attach(out, trucks, "truck_id", "id", ["truck_model_type", "truck_model_type_name"])
    return out.drop("truck_id")


def dispatches_to_date(daily: DataFrame) -> DataFrame:
    return daily.agg(F.sum("order_count").alias("order_count"), F.sum("order_amount").alias("order_amount"))


def bound_finishes_to_date(finish_rows: DataFrame) -> DataFrame:
    per_order = finish_rows.groupBy("order_id").agg(F.max("amount").alias("_amount"))
    return per_order.agg(F.count("order_id").alias("order_count"), F.sum("_amount").alias("order_amount"))
