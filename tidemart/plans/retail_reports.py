"""Retail reports. `as_of` is the report day as a date column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.ratios import percent, share
from ..functions.timekeys import within_recent
from ..operators.joins import attach, merge_metrics
from ..operators.paths import step_pairs
from ..operators.ranking import top_per_group
from ..operators.recent import last_seen_counts, recent_sums, span_rows
from .retail_dims import CATEGORY_COLUMNS

SPANS = (1, 7, 30)


def _dated(df: DataFrame, as_of: Column) -> DataFrame:
    return df.withColumn("dt", as_of)


def traffic_by_channel(sessions: DataFrame, as_of: Column, spans: Sequence[int] = SPANS) -> DataFrame:
    """Visitors, average stay and pages, sessions and bounce rate per channel and span."""
    rows = sessions.withColumn("_one", F.lit(1)) \
        .withColumn("_bounced", (F.col("page_count_1d") == 1).cast("int"))
    sums = {"_stay": "during_time_1d", "_pages": "page_count_1d", "sv_count": "_one", "_bounces": "_bounced"}
    longest = rows.filter(within_recent(F.col("dt"), as_of, max(spans)))
    totals = longest.groupBy("channel").agg(*recent_sums("dt", as_of, spans, sums))
    visitors = last_seen_counts(sessions, ["channel"], "mid_id", "dt", as_of, spans, "uv_count")
    wide = merge_metrics(["channel"], totals, visitors)
    long = span_rows(wide, ["channel"], spans, [*sums, "uv_count"]).filter("sv_count > 0")
    average = lambda c: F.col(c).cast("double") / F.col("sv_count")
    return _dated(long.select(
        "recent_days", "channel", "uv_count", (average("_stay") / 1000).cast("bigint").alias("avg_duration_sec"),
        average("_pages").cast("bigint").alias("avg_page_count"), "sv_count",
        share(F.col("_bounces"), F.col("sv_count"), 2).alias("bounce_rate")), as_of)


def page_paths(views: DataFrame) -> DataFrame:
    """Moves between numbered steps of a session, per day."""
    return step_pairs(views, "session_id", "page_id", "view_time", ["page_item", "during_time", "page_id"], ["dt"])


def user_change(logins_td: DataFrame, as_of: Column) -> DataFrame:
    """Users last seen exactly seven days ago, and users back after eight or more days."""
    back = (F.col("login_date_last") == as_of) & (F.datediff(F.col("login_date_last"), F.col("login_date_previous")) >= 8)
    return _dated(logins_td.agg(
        F.count(F.when(F.col("login_date_last") == F.date_sub(as_of, 7), 1)).alias("user_churn_count"),
        F.count(F.when(back, 1)).alias("user_back_count")), as_of)


def user_retention(logins_td: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    first = F.col("login_date_first")
    cohort = logins_td.filter((first >= F.date_sub(as_of, days)) & (first < as_of))
    out = cohort.groupBy(first.alias("create_date")).agg(
        F.count(F.when(F.col("login_date_last") == as_of, 1)).alias("retention_count"),
        F.count(F.lit(1)).alias("new_user_count"))
    return _dated(out.select(
        "create_date", F.datediff(as_of, "create_date").cast("bigint").alias("retention_day"), "retention_count",
        "new_user_count",
        percent(F.col("retention_count"), F.col("new_user_count")).alias("retention_rate")), as_of)


def user_stats(logins_td: DataFrame, as_of: Column, spans: Sequence[int] = SPANS) -> DataFrame:
    """New and active users per span from one pass."""
    metrics = []
    for n in spans:
        active = within_recent(F.col("login_date_last"), as_of, n)
        new = active & within_recent(F.col("login_date_first"), as_of, n)
        metrics += [F.count(F.when(new, 1)).alias(f"new_user_count_{n}d"),
                    F.count(F.when(active, 1)).alias(f"active_user_count_{n}d")]
    return _dated(span_rows(logins_td.agg(*metrics), [], spans, ["new_user_count", "active_user_count"]), as_of)


def action_funnel(page_visitors: DataFrame, carts: DataFrame, orders: DataFrame, payments: DataFrame) -> DataFrame:
    """People on the home page, on a product page, with cart adds, orders and payments, per day."""
    pages = page_visitors.filter(F.col("page_id").isin("home", "good_detail")).groupBy("dt").agg(
        F.count(F.when(F.col("page_id") == "home", 1)).alias("home_count"),
        F.count(F.when(F.col("page_id") == "good_detail", 1)).alias("good_detail_count"))
    people = [df.groupBy("dt").agg(F.count(F.lit(1)).alias(name)) for df, name in
              ((carts, "cart_count"), (orders, "order_count"), (payments, "payment_count"))]
    merged = merge_metrics(["dt"], pages, *people)
    return merged.na.fill(0, [c for c in merged.columns if c != "dt"])


def new_order_users(orders_td: DataFrame, as_of: Column, spans: Sequence[int] = SPANS) -> DataFrame:
    counts = [F.count(F.when(within_recent(F.col("order_date_first"), as_of, n), 1))
              .alias(f"new_order_user_count_{n}d") for n in spans]
    return _dated(span_rows(orders_td.agg(*counts), [], spans, ["new_order_user_count"]), as_of)


def consecutive_buyers(user_days: DataFrame, as_of: Column, run: int = 3, span: int = 7) -> DataFrame:
    """Users who ordered on `run` days in a row within the span. A user has at most
    `span` rows here, so the window stays small for every user."""
    days = user_days.filter(within_recent(F.col("dt"), as_of, span)).select("user_id", "dt").distinct()
    ahead = F.lead("dt", run - 1).over(W.partitionBy("user_id").orderBy("dt"))
    hits = days.withColumn("_gap", F.datediff(ahead, F.col("dt"))).filter(F.col("_gap") == run - 1)
    return _dated(hits.select("user_id").distinct().agg(
        F.count(F.lit(1)).alias("order_continuously_user_count")).withColumn("recent_days", F.lit(span)), as_of)


def repeat_rate_by_brand(user_sku_days: DataFrame, sku: DataFrame, as_of: Column, span: int = 30) -> DataFrame:
    """Buyers with two or more orders over buyers, per brand."""
    recent = user_sku_days.filter(within_recent(F.col("dt"), as_of, span)) \
        .groupBy("user_id", "sku_id").agg(F.sum("order_count_1d").alias("_n"))
    buyers = attach(recent, sku, "sku_id", "id", ["tm_id", "tm_name"]) \
        .groupBy("tm_id", "tm_name", "user_id").agg(F.sum("_n").alias("_n"))
    out = buyers.groupBy("tm_id", "tm_name").agg(
        share(F.count(F.when(F.col("_n") >= 2, 1)), F.count(F.lit(1)), 2).alias("order_repeat_rate"))
    return _dated(out.withColumn("recent_days", F.lit(span)), as_of)


def _orders_by(user_sku_days: DataFrame, sku: DataFrame, keys: list[str], as_of: Column,
               spans: Sequence[int]) -> DataFrame:
    """Orders and buyers per key and span.

    Rows shrink to (user, sku) before the dimension joins, then to (key, user);
    a buyer belongs to a span exactly if the buyer's last order day does.
    """
    recent = user_sku_days.filter(within_recent(F.col("dt"), as_of, max(spans)))
    sums = {"order_count": "order_count_1d"}
    per_user_sku = recent.groupBy("user_id", "sku_id").agg(
        *recent_sums("dt", as_of, spans, sums), F.max("dt").alias("_last"))
    per_user = attach(per_user_sku, sku, "sku_id", "id", keys).groupBy(*keys, "user_id").agg(
        *[F.sum(f"order_count_{n}d").alias(f"order_count_{n}d") for n in spans], F.max("_last").alias("_last"))
    wide = per_user.groupBy(*keys).agg(
        *[F.sum(f"order_count_{n}d").alias(f"order_count_{n}d") for n in spans],
        *[F.count(F.when(within_recent(F.col("_last"), as_of, n), F.col("user_id"))).alias(f"order_user_count_{n}d")
          for n in spans])
    long = span_rows(wide, keys, spans, ["order_count", "order_user_count"])
    return _dated(long.filter("order_count > 0"), as_of)


def orders_by_brand(user_sku_days: DataFrame, sku: DataFrame, as_of: Column,
                    spans: Sequence[int] = SPANS) -> DataFrame:
    return _orders_by(user_sku_days, sku, ["tm_id", "tm_name"], as_of, spans)


def orders_by_category(user_sku_days: DataFrame, sku: DataFrame, as_of: Column,
                       spans: Sequence[int] = SPANS) -> DataFrame:
    return _orders_by(user_sku_days, sku, CATEGORY_COLUMNS, as_of, spans)


def top_cart_sku_by_category(cart: DataFrame, sku: DataFrame, k: int = 3) -> DataFrame:
    stock = cart.groupBy("sku_id").agg(F.sum("sku_num").alias("cart_num"))
    named = attach(stock, sku, "sku_id", "id", ["sku_name", *CATEGORY_COLUMNS])
    return top_per_group(named, ["category1_id", "category2_id", "category3_id"], [F.col("cart_num").desc()], k)


def top_favor_sku_by_brand(favor_days: DataFrame, k: int = 3) -> DataFrame:
    picked = favor_days.select("dt", "tm_id", "tm_name", "sku_id", "sku_name",
                               F.col("favor_add_count_1d").alias("favor_count"))
    return top_per_group(picked, ["dt", "tm_id"], [F.col("favor_count").desc()], k)


def order_to_pay_seconds(flow: DataFrame) -> DataFrame:
    """Average seconds from order to payment, per payment day."""
    paid = flow.filter(F.col("payment_time").isNotNull())
    gap = F.unix_seconds("payment_time") - F.unix_seconds("order_time")
    return paid.groupBy(F.col("payment_date_id").alias("dt")).agg(
        (F.sum(gap).cast("double") / F.count(F.lit(1))).cast("bigint").alias("order_to_pay_interval_avg"))


def orders_by_province(lines: DataFrame, provinces: DataFrame, as_of: Column,
                       spans: Sequence[int] = SPANS) -> DataFrame:
    """Order count and amount per province and span; names join after the roll-up."""
    daily = lines.groupBy("province_id", "dt").agg(
        F.count_distinct("order_id").alias("_orders"), F.sum("split_total_amount").alias("_amount"))
    recent = daily.filter(within_recent(F.col("dt"), as_of, max(spans)))
    wide = recent.groupBy("province_id").agg(*recent_sums(
        "dt", as_of, spans, {"order_count": "_orders", "order_total_amount": "_amount"}))
    long = span_rows(wide, ["province_id"], spans, ["order_count", "order_total_amount"]).filter("order_count > 0")
    return _dated(attach(long, provinces, "province_id", "id",
                         ["province_name", "area_code", "iso_code", "iso_3166_2"]), as_of)


def coupon_stats(coupon_days: DataFrame) -> DataFrame:
    return coupon_days.groupBy("dt", "coupon_id", "coupon_name").agg(
        F.sum("used_count_1d").alias("used_count"), F.count(F.lit(1)).alias("used_user_count"))
