"""Product, user, activity and trade summaries of shop behaviour, and their calendar reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.ratios import bounce_rate, share, short_stay
from ..functions.timekeys import month_key, week_start
from ..operators.joins import attach

PRODUCT = ["product_name", "category_id", "category_name"]
SALE_ACTIVITY = "JUHUASUAN"


def rolling_days(ts: str, as_of: Column, days: int = 30) -> Column:
    """From the start of the day `days` before `as_of` on."""
    return F.col(ts) >= F.date_sub(as_of, days).cast("timestamp")


def recent_fact(rows: DataFrame, products: DataFrame, ts: str, as_of: Column, days: int = 30) -> DataFrame:
    """Recent rows of known products, with product attributes."""
    return attach(rows.filter(rolling_days(ts, as_of, days)), products, "product_id", "product_id", PRODUCT, "inner")


def visit_fact(visits: DataFrame, products: DataFrame, as_of: Column) -> DataFrame:
    return recent_fact(visits.filter(F.col("stay_seconds") > 0), products, "visit_time", as_of)


def valid_payments(payments: DataFrame, orders: DataFrame) -> DataFrame:
    """Positive amounts paid at or after the time of their order."""
    placed = orders.select(F.col("order_id").alias("_order"), F.col("order_time").alias("_placed"))
    paid = payments.filter(F.col("pay_amount") > 0)
    joined = paid.join(placed, (paid["order_id"] == placed["_order"]) & (paid["pay_time"] >= placed["_placed"]))
    return joined.drop("_order", "_placed")


def payment_fact(payments: DataFrame, orders: DataFrame, products: DataFrame, as_of: Column) -> DataFrame:
    return recent_fact(valid_payments(payments, orders), products, "pay_time", as_of)


def _merge_left(first: DataFrame, keys: list[str], *others: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.join(b, keys, "left"), others, first)


def product_day(visits, favorites, carts, orders, payments, refunds) -> DataFrame:
    """One row per product and visit day. Each fact is summed per product and day
    before the join, so no fact multiplies the rows of another."""
    def per_day(df, ts, *aggs):
        return df.groupBy(F.to_date(ts).alias("summary_date"), "product_id").agg(*aggs)

    seen = visits.groupBy(F.to_date("visit_time").alias("summary_date"), "product_id", *PRODUCT).agg(
        F.count_distinct("user_id").alias("uv"), F.count(F.lit(1)).alias("pv"),
        F.round(share(F.sum("stay_seconds"), F.count(F.lit(1))), 2).cast("decimal(16,2)").alias("avg_stay_seconds"),
        bounce_rate(short_stay(F.col("stay_seconds"), 3)).cast("decimal(16,4)").alias("bounce_rate"),
        F.count_distinct(F.when(F.col("is_micro_detail") == 1, F.col("user_id"))).alias("micro_detail_uv"))
    fav = per_day(favorites, "fav_time", F.count_distinct("user_id").alias("fav_users"))
    cart = per_day(carts, "cart_time", F.count_distinct("user_id").alias("cart_users"), F.sum("quantity").alias("cart_qty"))
    placed = per_day(orders, "order_time", F.count_distinct("user_id").alias("order_users"),
                     F.sum("quantity").alias("order_qty"), F.sum("order_amount").alias("order_amount"))
    sale = F.when(F.col("activity_type") == SALE_ACTIVITY, F.col("pay_amount"))
    paid = per_day(payments, "pay_time", F.count_distinct("user_id").alias("pay_users"),
                   F.count(F.when(F.col("pay_amount") > 0, 1)).alias("pay_qty"), F.sum("pay_amount").alias("pay_amount"),
                   F.sum(sale).alias("juhuasuan_pay_amount"))
    back = per_day(refunds, "refund_time", F.sum("refund_amount").alias("refund_amount"))
    out = _merge_left(seen, ["summary_date", "product_id"], fav, cart, placed, paid, back)
    counts = ["fav_users", "cart_users", "order_users", "pay_users", "pay_qty", "juhuasuan_pay_amount"]
    return out.na.fill(0, counts) \
        .withColumn("active_products", F.when(F.col("pay_qty") > 0, 1).otherwise(0)) \
        .withColumn("item_unit_price", share(F.col("pay_amount"), F.col("order_qty"), 2))


def user_day(visits, favorites, carts, orders, payments, refunds) -> DataFrame:
    """Per user and day: products seen, and on how many of them the user acted that day."""
    keys = ["summary_date", "user_id", "product_id"]

    def per_key(df, ts, *aggs):
        return df.groupBy(F.to_date(ts).alias("summary_date"), "user_id", "product_id").agg(*aggs)

    seen = per_key(visits, "visit_time", F.count(F.lit(1)).alias("pv"))
    acted = [per_key(df, ts, F.max(F.lit(1)).alias(flag)) for df, ts, flag in (
        (favorites, "fav_time", "fav"), (carts, "cart_time", "cart"), (orders, "order_time", "ord"))]
    paid = per_key(payments, "pay_time", F.max(F.lit(1)).alias("pay"), F.sum("pay_amount").alias("pay_amount"))
    back = per_key(refunds, "refund_time", F.sum("refund_amount").alias("refund_amount"))
    wide = _merge_left(seen, keys, *acted, paid, back)
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return wide.groupBy("summary_date", "user_id").agg(
        F.count("product_id").alias("visit_products"), F.sum("pv").alias("pv"), zero("fav").alias("fav_count"),
        zero("cart").alias("cart_count"), zero("ord").alias("order_count"), zero("pay").alias("pay_count"),
        zero("pay_amount").alias("total_pay_amount"), zero("refund_amount").alias("total_refund_amount"))


def _order_money(orders, payments, refunds) -> DataFrame:
    """Orders with what was paid and refunded on them."""
    paid = payments.groupBy("order_id").agg(F.sum("pay_amount").alias("pay_amount"), F.max("user_id").alias("pay_user_id"))
    back = refunds.groupBy("order_id").agg(F.sum("refund_amount").alias("refund_amount"))
    return _merge_left(orders.withColumn("summary_date", F.to_date("order_time")), ["order_id"], paid, back)


def activity_day(orders, payments, refunds) -> DataFrame:
    return _order_money(orders, payments, refunds).groupBy("summary_date", "activity_type").agg(
        F.count_distinct("user_id").alias("uv"), F.sum("order_amount").alias("total_order_amount"),
        F.sum(F.coalesce("pay_amount", F.lit(0))).alias("total_pay_amount"),
        F.sum(F.coalesce("refund_amount", F.lit(0))).alias("total_refund_amount"))


def trade_day(orders, payments, refunds) -> DataFrame:
    return _order_money(orders, payments, refunds).groupBy("summary_date").agg(
        F.count_distinct("user_id").alias("uv"), F.count_distinct("order_id").alias("order_count"),
        F.sum("order_amount").alias("total_order_amount"), F.count_distinct("pay_user_id").alias("pay_user_count"),
        F.sum("pay_amount").alias("total_pay_amount"), F.sum("refund_amount").alias("total_refund_amount"))


_PRODUCT_REPORT = ["uv", "pv", "avg_stay_seconds", "bounce_rate", "fav_users", "cart_users", "order_users", "pay_users",
                   "pay_amount", "refund_amount"]
_TRADE_REPORT = ["uv", "order_count", "total_order_amount", "pay_user_count", "total_pay_amount", "total_refund_amount"]


def product_report_day(days: DataFrame) -> DataFrame:
    return days.select("summary_date", "product_id", *PRODUCT, *_PRODUCT_REPORT)


def _product_roll_up(days: DataFrame, *period: Column) -> DataFrame:
    mean = {"avg_stay_seconds": 2, "bounce_rate": 4}
    aggs = [share(F.sum(c), F.count(F.lit(1)), mean[c]).alias(c) if c in mean else F.sum(c).alias(c)
            for c in _PRODUCT_REPORT]
    return days.groupBy(*period, "product_id", *PRODUCT).agg(F.min("summary_date").alias("week_start"), *aggs)


def product_report_week(days: DataFrame) -> DataFrame:
    """Calendar weeks from Monday; `week_start` is the first day with data."""
    return _product_roll_up(days, week_start(F.col("summary_date")).alias("week_monday"))


def product_report_month(days: DataFrame) -> DataFrame:
    return _product_roll_up(days, month_key(F.col("summary_date")).alias("month_key")).drop("week_start")


def trade_report_day(days: DataFrame) -> DataFrame:
    return days.select("summary_date", *_TRADE_REPORT)


def trade_report_week(days: DataFrame) -> DataFrame:
    return days.groupBy(week_start(F.col("summary_date")).alias("week_monday")).agg(
        F.min("summary_date").alias("week_start"), *[F.sum(c).alias(c) for c in _TRADE_REPORT])


def trade_report_month(days: DataFrame) -> DataFrame:
    return days.groupBy(month_key(F.col("summary_date")).alias("month_key")).agg(
        *[F.sum(c).alias(c) for c in _TRADE_REPORT])
