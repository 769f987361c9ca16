"""Product rankings, traffic sources and strength warnings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.cleaning import star_in_range
from ..functions.ratios import percent_text, share
from ..functions.timekeys import within_recent
from ..operators.joins import attach
from ..operators.ranking import ranked, top_overall
from ..operators.sets import union_all

PRICE_WARNING, PRODUCT_WARNING = "价格力预警", "商品力预警"


def product_fact(products: DataFrame) -> DataFrame:
    return products.filter(F.col("product_id").isNotNull()) \
        .withColumn("price_strength_star", star_in_range(F.col("price_strength_star")))


def order_fact(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("pay_time").isNotNull()).withColumn("dt", F.to_date("pay_time"))


def traffic_fact(traffic: DataFrame) -> DataFrame:
    return traffic.filter(F.col("visitor_count") > 0).withColumn("dt", F.to_date("visit_time"))


def inventory_fact(inventory: DataFrame) -> DataFrame:
    return inventory.withColumn("dt", F.to_date("update_time"))


def sale_totals(orders: DataFrame, products: DataFrame, as_of: Column, span: int = 7) -> DataFrame:
    recent = orders.filter(within_recent(F.col("dt"), as_of, span))
    totals = recent.groupBy("product_id").agg(
        F.sum("pay_amount").alias("total_sales"), F.sum("pay_quantity").alias("total_quantity"),
        F.sum("buyer_count").alias("total_buyer_count"))
    return attach(totals, products, "product_id", "product_id", ["category_id", "product_name"], "inner") \
        .withColumn("stat_period", F.lit(f"{span}d"))


def traffic_totals(traffic: DataFrame, orders: DataFrame) -> DataFrame:
    """Visitors per product, source and search word and day, with the paying share.

    Buyers are summed per product and day first; `pay_conversion` is in percent.
    """
    word = F.coalesce("search_word", F.lit("")).alias("search_word")
    seen = traffic.groupBy("product_id", "source", word, "dt").agg(F.sum("visitor_count").alias("total_visitor"))
    buyers = orders.groupBy("product_id", "dt").agg(F.sum("buyer_count").alias("_buyers"))
    out = seen.join(buyers, ["product_id", "dt"], "left")
    return out.withColumn("pay_conversion", share(F.col("_buyers") * 100, F.col("total_visitor"), 2)) \
        .withColumn("pay_conversion_rate", percent_text(F.col("pay_conversion"))).drop("_buyers")


def strength_flags(products: DataFrame, traffic_days: DataFrame, as_of: Column, price_limit: int = 2,
                   conversion_limit: float = 5.0) -> DataFrame:
    """Weak price strength and weak conversion per product, by rule only."""
    best = traffic_days.filter(F.col("dt") == as_of).groupBy("product_id").agg(F.max("pay_conversion").alias("_best"))
    stars = products.groupBy("product_id").agg(F.max("price_strength_star").alias("price_strength_star"))
    out = attach(stars, best, "product_id", "product_id", ["_best"])
    flag = lambda test: F.when(test, 1).otherwise(0)
    return out.withColumn("is_price_warn", flag(F.col("price_strength_star") <= price_limit)) \
        .withColumn("is_product_warn", flag(F.col("_best") < conversion_limit)).drop("_best")


def product_ranking(totals: DataFrame) -> DataFrame:
    """Rank of every product by sales and, separately, by quantity."""
    kept = totals.select("product_id", "product_name", "category_id", "total_sales", "total_quantity", "stat_period")
    by_sales = ranked(kept, "total_sales", ["product_id"], "sales_rank")
    both = ranked(by_sales, "total_quantity", ["product_id"], "quantity_rank")
    return both.drop("total_sales", "total_quantity")


def top_sources(traffic_days: DataFrame, as_of: Column, k: int = 10) -> DataFrame:
    day = traffic_days.filter(F.col("dt") == as_of)
    totals = day.groupBy("source").agg(
        F.sum("total_visitor").alias("total_visitor"),
        share(F.sum(F.col("pay_conversion").cast("decimal(18,2)")), F.count("pay_conversion"), 2).alias("_mean"))
    best = top_overall(totals, [F.col("total_visitor").desc(), F.col("source")], k)
    return best.withColumn("pay_conversion_rate", percent_text(F.col("_mean"))).drop("_mean")


def warnings(flags: DataFrame) -> DataFrame:
    kinds = [(PRICE_WARNING, "is_price_warn"), (PRODUCT_WARNING, "is_product_warn")]
    return union_all(*[flags.filter(F.col(flag) == 1).select(
        "product_id", F.lit(name).alias("warn_type"), "price_strength_star") for name, flag in kinds])
