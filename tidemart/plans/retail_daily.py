"""Retail summaries per day, over recent days and to date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.joins import attach
from ..operators.recent import recent_wide
from .retail_dims import SKU_COLUMNS

ORDER_SUMS = {"order_num_1d": "sku_num", "order_original_amount_1d": "split_original_amount",
              "activity_reduce_amount_1d": "split_activity_amount",
              "coupon_reduce_amount_1d": "split_coupon_amount", "order_total_amount_1d": "split_total_amount"}


def _sums(columns: dict[str, str]) -> list[Column]:
    return [F.sum(src).alias(out) for out, src in columns.items()]


def user_sku_orders(lines: DataFrame) -> DataFrame:
    """User x sku x day before any dimension is joined."""
    return lines.groupBy("user_id", "sku_id", "dt").agg(
        F.count("id").alias("order_count_1d"), *_sums(ORDER_SUMS))


def user_sku_order_daily(lines: DataFrame, sku: DataFrame) -> DataFrame:
    """Aggregated first, so the dimension meets far fewer rows than the fact has."""
    return attach(user_sku_orders(lines), sku, "sku_id", "id", SKU_COLUMNS)


def user_order_daily(lines: DataFrame) -> DataFrame:
    return lines.groupBy("user_id", "dt").agg(F.count("order_id").alias("order_count_1d"), *_sums(ORDER_SUMS))


def user_cart_daily(carts: DataFrame) -> DataFrame:
    return carts.groupBy("user_id", "dt").agg(F.count(F.lit(1)).alias("cart_add_count_1d"),
                                              F.sum("sku_num").alias("cart_add_num_1d"))


def user_payment_daily(payments: DataFrame) -> DataFrame:
    return payments.groupBy("user_id", F.col("date_id").alias("dt")).agg(
        F.count_distinct("order_id").alias("payment_count_1d"), F.sum("sku_num").alias("payment_num_1d"),
        F.sum("split_payment_amount").alias("payment_amount_1d"))


PROVINCE_COLUMNS = ["province_name", "area_code", "iso_code", "iso_3166_2"]


def province_orders(lines: DataFrame) -> DataFrame:
    sums = {k: v for k, v in ORDER_SUMS.items() if k != "order_num_1d"}
    return lines.groupBy("province_id", "dt").agg(F.count_distinct("order_id").alias("order_count_1d"), *_sums(sums))


def province_order_daily(lines: DataFrame, provinces: DataFrame) -> DataFrame:
    return attach(province_orders(lines), provinces, "province_id", "id", PROVINCE_COLUMNS)


def coupon_used_daily(uses: DataFrame, coupons: DataFrame) -> DataFrame:
    daily = uses.groupBy("user_id", "coupon_id", "dt").agg(F.count(F.lit(1)).alias("used_count_1d"))
    return attach(daily, coupons, "coupon_id", "id",
                  ["coupon_name", "coupon_type", "coupon_type_name", "benefit_rule"])


def sku_favor_daily(favors: DataFrame, sku: DataFrame) -> DataFrame:
    daily = favors.groupBy("sku_id", "dt").agg(F.count(F.lit(1)).alias("favor_add_count_1d"))
    return attach(daily, sku, "sku_id", "id", SKU_COLUMNS)


def session_daily(views: DataFrame) -> DataFrame:
    return views.groupBy("session_id", "mid_id", "brand", "model", "operate_system", "version_code", "channel",
                         "dt").agg(F.sum("during_time").alias("during_time_1d"),
                                   F.count(F.lit(1)).alias("page_count_1d"))


def page_visitor_daily(views: DataFrame) -> DataFrame:
    return views.groupBy("mid_id", "brand", "model", "operate_system", "page_id", "dt").agg(
        F.sum("during_time").alias("during_time_1d"), F.count(F.lit(1)).alias("view_count_1d"))


_ND = {k[:-3]: k for k in ("order_count_1d", *ORDER_SUMS)}


def user_sku_order_recent(lines: DataFrame, sku: DataFrame, as_of: Column, spans=(7, 30)) -> DataFrame:
    """7- and 30-day columns; the dimension joins after the roll-up."""
    wide = recent_wide(user_sku_orders(lines), "dt", as_of, spans, ["user_id", "sku_id"], _ND)
    return attach(wide, sku, "sku_id", "id", SKU_COLUMNS)


def province_order_recent(lines: DataFrame, provinces: DataFrame, as_of: Column, spans=(7, 30)) -> DataFrame:
    sums = {k: v for k, v in _ND.items() if k != "order_num"}
    wide = recent_wide(province_orders(lines), "dt", as_of, spans, ["province_id"], sums)
    return attach(wide, provinces, "province_id", "id", PROVINCE_COLUMNS)


def user_order_to_date(lines: DataFrame, as_of: Column) -> DataFrame:
    return lines.filter(F.col("dt") <= as_of).groupBy("user_id").agg(
        F.min("dt").alias("order_date_first"), F.max("dt").alias("order_date_last"),
        F.count("order_id").alias("order_count_td"),
        *[F.sum(src).alias(out[:-3] + "_td") for out, src in ORDER_SUMS.items()])


def user_login_to_date(users: DataFrame, logins: DataFrame, as_of: Column) -> DataFrame:
    """Last and first login day and login count; users without a login count from registration.

    `login_date_previous` is the last day the same table showed one day earlier.
    """
    known = users.select(F.col("id").cast("string").alias("user_id"), F.to_date("create_time").alias("_made")) \
        .filter(F.col("_made") <= as_of)
    seen = logins.filter(F.col("dt") <= as_of).groupBy("user_id").agg(
        F.max("dt").alias("_last"), F.count(F.lit(1)).alias("_count"),
        F.max(F.when(F.col("dt") < as_of, F.col("dt"))).alias("_previous"))
    out = attach(known, seen, "user_id", "user_id", ["_last", "_count", "_previous"])
    return out.select(
        "user_id", F.coalesce("_last", "_made").alias("login_date_last"), F.col("_made").alias("login_date_first"),
        F.coalesce("_count", F.lit(1)).alias("login_count_td"),
        F.when(F.col("_made") < as_of, F.coalesce("_previous", "_made")).alias("login_date_previous"))
