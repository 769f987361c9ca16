"""Retail dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.promotions import ACTIVITY_KINDS, COUPON_KINDS, rule_text
from ..operators.history import open_versions
from ..operators.joins import attach


def category_levels(category3: DataFrame, category2: DataFrame, category1: DataFrame) -> DataFrame:
    """Three category levels in one row per lowest category."""
    c3 = category3.select(F.col("id").alias("category3_id"), F.col("name").alias("category3_name"),
                          "category2_id")
    c3 = attach(c3, category2, "category2_id", "id",
                {"category2_name": "name", "category1_id": "category1_id"})
    return attach(c3, category1, "category1_id", "id", {"category1_name": "name"})


CATEGORY_COLUMNS = ["category1_id", "category1_name", "category2_id", "category2_name",
                    "category3_id", "category3_name"]
SKU_COLUMNS = ["sku_name", *CATEGORY_COLUMNS, "tm_id", "tm_name"]


def sku_core(sku: DataFrame, spu: DataFrame, categories: DataFrame, trademark: DataFrame) -> DataFrame:
    """One row per sku with product, category levels and brand."""
    out = attach(sku, spu, "spu_id", "id", {"spu_name": "spu_name", "_c3": "category3_id"})
    out = attach(out, categories, "_c3", "category3_id", CATEGORY_COLUMNS).drop("_c3")
    return attach(out, trademark, "tm_id", "id", {"tm_name": "tm_name"})


def sku_dim(sku: DataFrame, spu: DataFrame, categories: DataFrame, trademark: DataFrame,
            attributes: DataFrame, sale_attributes: DataFrame) -> DataFrame:
    """Sku rows with their attributes; one row per attribute combination."""
    out = sku_core(sku, spu, categories, trademark)
    out = attach(out, attributes, "id", "sku_id",
                 {"attr_id": "id", "attr_name": "attr_name", "attr_value_name": "value_name"})
    return attach(out, sale_attributes, "id", "sku_id",
                  {"sale_attr_id": "id", "sale_attr_name": "sale_attr_name",
                   "sale_attr_value_name": "sale_attr_value_name"})


def _entries(dictionary: DataFrame, parent: str) -> DataFrame:
    return dictionary.filter(F.col("parent_code") == parent)


def coupon_dim(coupons: DataFrame, dictionary: DataFrame) -> DataFrame:
    out = attach(coupons, _entries(dictionary, "32"), "coupon_type", "dic_code",
                 {"coupon_type_name": "dic_name"})
    out = attach(out, _entries(dictionary, "33"), "range_type", "dic_code",
                 {"range_type_name": "dic_name"})
    return out.withColumn("benefit_rule", rule_text(
        F.col("coupon_type"), COUPON_KINDS, F.col("condition_amount"), F.col("condition_num"),
        F.col("benefit_amount"), F.col("benefit_discount")))


def activity_dim(rules: DataFrame, activities: DataFrame, dictionary: DataFrame) -> DataFrame:
    out = attach(rules, activities, "activity_id", "id", ["activity_name"])
    out = attach(out, _entries(dictionary, "31"), "activity_type", "dic_code",
                 {"activity_type_name": "dic_name"})
    return out.withColumn("benefit_rule", rule_text(
        F.col("activity_type"), ACTIVITY_KINDS, F.col("condition_amount"), F.col("condition_num"),
        F.col("benefit_amount"), F.col("benefit_discount")))


def province_dim(provinces: DataFrame, regions: DataFrame) -> DataFrame:
    named = provinces.withColumnRenamed("name", "province_name")
    return attach(named, regions, "region_id", "id", ["region_name"])


def promotion_position_dim(positions: DataFrame) -> DataFrame:
    return positions.select("id", "pos_location", "pos_type", "promotion_type")


def promotion_referrer_dim(referrers: DataFrame) -> DataFrame:
    return referrers.select("id", "refer_name")


def date_dim(bounds: DataFrame) -> DataFrame:
    """Calendar rows for each day from `first_day` to `last_day` of the one-row input."""
    day = F.col("day")
    return bounds.select(F.explode(F.sequence("first_day", "last_day")).alias("day")).select(
        F.date_format(day, "yyyyMMdd").alias("date_id"), day,
        F.weekofyear(day).cast("bigint").alias("week_id"),
        F.dayofweek(day).cast("bigint").alias("_dow"), F.dayofmonth(day).cast("bigint").alias("day_of_month"),
        F.month(day).cast("bigint").alias("month"), F.quarter(day).cast("bigint").alias("quarter"),
        F.year(day).cast("bigint").alias("year")) \
        .withColumn("week_day", (F.col("_dow") + 5) % 7 + 1) \
        .withColumn("is_workday", F.when(F.col("week_day") <= 5, "1").otherwise("0")).drop("_dow")


USER_ZIP_COLUMNS = ["name", "phone_num", "email", "user_level", "birthday", "gender", "create_time"]


def user_zip(users: DataFrame, start: Column) -> DataFrame:
    """First load of the user history."""
    return open_versions(users.select("id", *USER_ZIP_COLUMNS), start)
