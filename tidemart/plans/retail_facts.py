"""Retail facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from .. import schemas
from ..functions.keys import parsed_once
from ..functions.timekeys import local_time
from ..operators.joins import attach
from ..operators.latest import latest_per_key

PAID = "1602"
FINISHED = "1004"


def cart_add_fact(carts: DataFrame) -> DataFrame:
    return carts.select("id", "user_id", "sku_id", F.to_date("create_time").alias("date_id"),
                        "create_time", "sku_num", F.to_date("create_time").alias("dt"))


def cart_snapshot(carts: DataFrame) -> DataFrame:
    """Items still in the cart."""
    return carts.filter(F.col("is_ordered") == 0).select("id", "user_id", "sku_id", "sku_name", "sku_num")


def order_line_core(detail: DataFrame, orders: DataFrame, order_columns: list[str]) -> DataFrame:
    """Order lines with amounts and chosen order columns: all the summaries need."""
    lines = detail.select(
        "id", "order_id", "sku_id", "create_time", "sku_num",
        (F.col("sku_num") * F.col("order_price")).cast("decimal(16,2)").alias("split_original_amount"),
        *[F.coalesce(F.col(c), F.lit(0)).cast("decimal(16,2)").alias(c)
          for c in ("split_activity_amount", "split_coupon_amount")],
        "split_total_amount")
    out = attach(lines, orders, "order_id", "id", order_columns)
    return out.withColumn("dt", F.to_date("create_time"))


def order_detail_fact(detail: DataFrame, orders: DataFrame, activities: DataFrame,
                      coupons: DataFrame) -> DataFrame:
    out = order_line_core(detail, orders, ["user_id", "province_id"])
    out = attach(out, activities, "id", "order_detail_id", ["activity_id", "activity_rule_id"])
    out = attach(out, coupons, "id", "order_detail_id", ["coupon_id"])
    return out.withColumn("date_id", F.col("dt"))


def payment_success_fact(order_detail: DataFrame, payments: DataFrame, dictionary: DataFrame,
                         how: str = "left") -> DataFrame:
    """Order lines with the successful payment of their order. The left form keeps
    unpaid lines with empty payment columns; `how="inner"` keeps paid lines only."""
    paid = payments.filter(F.col("payment_status") == PAID)
    out = attach(order_detail.withColumnRenamed("order_id", "_order"), paid, "_order", "order_id",
                 {"order_id": "order_id", "pay_user_id": "user_id", "payment_type_code": "payment_type",
                  "callback_time": "callback_time"}, how)
    names = dictionary.filter(F.col("parent_code") == "11")
    out = attach(out, names, "payment_type_code", "dic_code", {"payment_type_name": "dic_name"})
    return out.select(
        "id", "order_id", F.col("pay_user_id").alias("user_id"), "sku_id", "province_id", "activity_id",
        "activity_rule_id", "coupon_id", "payment_type_code", "payment_type_name",
        F.to_date("callback_time").alias("date_id"), "callback_time", "sku_num",
        (F.col("split_activity_amount") + F.col("split_coupon_amount") + F.col("split_total_amount"))
        .cast("decimal(16,2)").alias("split_original_amount"),
        "split_activity_amount", "split_coupon_amount",
        F.col("split_total_amount").alias("split_payment_amount"))


def trade_flow(orders: DataFrame, payments: DataFrame, status_log: DataFrame) -> DataFrame:
    """One row per order with its order, payment and finish times."""
    out = attach(orders, payments.filter(F.col("payment_status") == PAID), "id", "order_id",
                 {"payment_time": "callback_time"})
    out = attach(out, status_log.filter(F.col("order_status") == FINISHED), "id", "order_id",
                 {"finish_time": "create_time"})
    reduced = F.col("activity_reduce_amount") + F.col("coupon_reduce_amount")
    return out.select(
        F.col("id").alias("order_id"), "user_id", "province_id",
        F.to_date("create_time").alias("order_date_id"), F.col("create_time").alias("order_time"),
        F.to_date("payment_time").alias("payment_date_id"), "payment_time",
        F.to_date("finish_time").alias("finish_date_id"), "finish_time",
        (F.col("total_amount") + reduced).cast("decimal(16,2)").alias("order_original_amount"),
        F.col("activity_reduce_amount").alias("order_activity_amount"),
        F.col("coupon_reduce_amount").alias("order_coupon_amount"),
        F.col("total_amount").alias("order_total_amount"), F.col("total_amount").alias("payment_amount"))


def coupon_used_fact(uses: DataFrame) -> DataFrame:
    return uses.filter(F.col("used_time").isNotNull()).select(
        "id", "coupon_id", "user_id", "order_id", F.to_date("used_time").alias("date_id"),
        F.col("used_time").alias("payment_time"), F.to_date("used_time").alias("dt"))


def favor_add_fact(favors: DataFrame) -> DataFrame:
    return favors.filter(F.col("is_cancel") == "0").select(
        "id", "user_id", "sku_id", F.to_date("create_time").alias("date_id"), "create_time",
        F.to_date("create_time").alias("dt"))


# Page views need the common and page parts only; the other parts are not built.
VIEW_LOG = T.StructType([schemas.PAGE_LOG[name] for name in ("common", "page", "ts")])


def parsed_views(raw: DataFrame) -> DataFrame:
    """Log lines with a page part, parsed once; unparseable lines have none."""
    record = F.from_json("log", VIEW_LOG, {"mode": "PERMISSIVE"})
    return raw.select("dt", F.inline(parsed_once(record, lambda r: r["page"].isNotNull())))


_DEVICE = {"channel": "ch", "province_id": "ar", "version_code": "vc", "mid_id": "mid", "brand": "ba",
           "model": "md", "operate_system": "os"}


def page_view_fact(raw: DataFrame) -> DataFrame:
    """Page views from JSON log lines."""
    seen = F.timestamp_millis("ts")
    return parsed_views(raw).select(
        *[F.col(f"common.{src}").alias(out) for out, src in
          {**_DEVICE, "is_new": "is_new", "user_id": "uid", "session_id": "sid"}.items()],
        F.col("page.item").alias("page_item"), F.col("page.item_type").alias("page_item_type"),
        *[F.col(f"page.{c}").alias(c) for c in
          ("last_page_id", "page_id", "from_pos_id", "from_pos_seq", "refer_id", "during_time")],
        F.to_date(seen).alias("date_id"), seen.alias("view_time"), F.col("dt"))


def register_fact(users: DataFrame, page_views: DataFrame) -> DataFrame:
    """Registrations with the device of the user's first logged page view."""
    ordered = [F.col("view_time"), F.col("mid_id"), F.col("page_item"), F.col("page_id")]
    device = latest_per_key(page_views.filter(F.col("user_id").isNotNull())
                            .select("user_id", "view_time", "page_item", "page_id", *_DEVICE), ["user_id"], ordered)
    out = attach(users.withColumn("_uid", F.col("id").cast("string")), device, "_uid", "user_id", list(_DEVICE))
    return out.select(F.col("id").alias("user_id"), F.to_date("create_time").alias("date_id"), "create_time",
                      *_DEVICE)


def login_fact(page_views: DataFrame, zone: str = "GMT+8") -> DataFrame:
    """First page view of each session of a known user, in local time."""
    known = page_views.filter(F.col("user_id").isNotNull())
    order = [F.col("view_time"), F.col("page_id"), F.col("page_item"), F.col("during_time")]
    first = latest_per_key(known, ["session_id"], order)
    local = local_time(F.unix_millis("view_time"), zone)
    return first.select("user_id", F.to_date(local).alias("date_id"), local.alias("login_time"), *_DEVICE,
                        F.col("dt"))
