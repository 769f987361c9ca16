"""User labels: age-band scores from device, search and orders, profile labels, label document."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.persona import decade, full_years, zodiac
from ..functions.timekeys import date_from_epoch_day, day_slot, local_time
from ..operators.joins import attach

BANDS = ("18_24", "25_29", "30_34", "35_39", "40_49", "50")

# Base score of each age band, youngest first, by factor and value.
DEVICE = {
    "iOS": (.7, .6, .5, .4, .3, .2),
    "Android": (.8, .7, .6, .5, .4, .3),
}
SEARCH = {
    "时尚与潮流": (.9, .7, .5, .3, .2, .1),
    "性价比": (.2, .4, .6, .7, .8, .8),
    "健康与养生": (.1, .2, .4, .6, .8, .7),
    "家庭与育儿": (.1, .2, .4, .6, .8, .7),
    "科技与数码": (.8, .6, .4, .3, .2, .1),
    "学习与发展": (.4, .5, .6, .7, .8, .7),
}
SEARCH_OTHER = (0, 0, 0, 0, 0, 0)
TIME_SLOT = {
    "凌晨": (.2, .1, .1, .1, .1, .1),
    "早晨": (.1, .1, .1, .1, .2, .3),
    "上午": (.2, .2, .2, .2, .3, .4),
    "中午": (.4, .4, .4, .4, .4, .3),
    "下午": (.4, .5, .5, .5, .5, .4),
    "晚上": (.8, .7, .6, .5, .4, .3),
    "夜间": (.9, .7, .5, .3, .2, .1),
}
AMOUNT = {
    "low": (.8, .6, .4, .3, .2, .1),
    "middle": (.2, .4, .6, .7, .8, .7),
    "high": (.1, .2, .3, .4, .5, .6),
}
AMOUNT_LIMITS = ((1000, "low"), (4000, "middle"))
AMOUNT_TOP = "high"
BRAND = {
    "TCL": (.2, .3, .4, .5, .6, .7),
    "苹果": (.9, .8, .7, .7, .7, .5),
    "联想": (.9, .8, .7, .7, .7, .5),
    "小米": (.9, .8, .7, .7, .7, .5),
    "欧莱雅": (.5, .6, .8, .8, .9, .2),
    "香奈儿": (.3, .4, .6, .8, .9, .2),
}
BRAND_OTHER = (.1, .2, .3, .4, .5, .6)
_YOUNG, _SETTLED = (.9, .8, .6, .4, .2, .1), (.2, .4, .6, .8, .9, .7)
CATEGORY = {
    **dict.fromkeys(("数码", "手机", "电脑办公", "个护化妆", "服饰内衣"), _YOUNG),
    **dict.fromkeys(("家居家装", "图书、音像、电子书刊", "厨具", "鞋靴", "母婴", "汽车用品", "珠宝", "家用电器"), _SETTLED),
}
CATEGORY_OTHER = (.1, .2, .4, .5, .8, .9)
# Weight of each factor.
WEIGHTS = {"device": .1, "search": .15, "pay_time": .1, "amount": .15, "tname": .2, "b1name": .3}


def _weighted(scores: Sequence[float], weight: float) -> Column:
    """Literal array of score x weight, half up to three digits, computed once on the driver."""
    cells = [(Decimal(str(s)) * Decimal(str(weight))).quantize(Decimal("0.001"), rounding="ROUND_HALF_UP") for s in scores]
    return F.array(*[F.lit(c).cast("decimal(5,3)") for c in cells])


def factor_scores(value: Column, table: Mapping[str, Sequence[float]], weight: float,
                  other: Sequence[float] | None = None) -> Column:
    """Array of six band scores of a value: a map literal, no join. Unlisted values take
    `other`; a missing value, or an unlisted one without `other`, scores nothing."""
    known = F.create_map(*[x for name, scores in table.items() for x in (F.lit(name), _weighted(scores, weight))])
    found = F.try_element_at(known, value)
    if other is not None:
        found = F.coalesce(found, F.when(value.isNotNull() & (value != ""), _weighted(other, weight)))
    return found


def _spread(df: DataFrame, scores: dict[str, Column]) -> DataFrame:
    """Score arrays as one column per factor and band."""
    out = df.withColumns({f"_{name}": col for name, col in scores.items()})
    return out.withColumns({f"{name}_{band}": F.col(f"_{name}")[i] for name in scores for i, band in enumerate(BANDS)}) \
        .drop(*[f"_{name}" for name in scores])


def device_search_scores(profiles: DataFrame, categories: DataFrame, compare: DataFrame,
                         weights: Mapping[str, float] = WEIGHTS) -> DataFrame:
    """Band scores of a user's first device system and of the last search's category.

    `categories`: b3name -> b1name; `compare`: category_name -> search_category.
    """
    out = profiles.withColumn("judge_os", F.element_at(F.split("os", ","), 1))
    out = attach(out, categories, "last_search", "b3name", {"b1_category": "b1name"})
    out = attach(out, compare, "b1_category", "category_name", {"search_category": "search_category"}) \
        .withColumn("search_category", F.coalesce("search_category", F.lit("unknown")))
    return _spread(out, {"device": factor_scores(F.col("judge_os"), DEVICE, weights["device"]),
                         "search": factor_scores(F.col("search_category"), SEARCH, weights["search"], SEARCH_OTHER)})


def spending_power(amount: Column) -> Column:
    level = None
    for limit, name in AMOUNT_LIMITS:
        level = F.when(amount < limit, name) if level is None else level.when(amount < limit, name)
    return F.when(amount.isNotNull(), level.otherwise(AMOUNT_TOP))


def order_scores(lines: DataFrame, skus: DataFrame, categories: DataFrame, zone: str = "Asia/Shanghai",
                 weights: Mapping[str, float] = WEIGHTS) -> DataFrame:
    """Band scores of an order line: time of day, order amount, brand, category.

    `skus`: skuid -> c3id, tname; `categories`: id -> b1name.
    """
    out = lines.withColumn("pay_time_slot", day_slot(local_time(F.col("create_time"), zone))) \
        .withColumn("spending_pow", spending_power(F.col("total_amount").cast("decimal(16,2)")))
    out = attach(out, skus, "sku_id", "skuid", ["c3id", "tname"])
    out = attach(out, categories, "c3id", "id", {"b1_name": "b1name"})
    return _spread(out, {
        "pay_time": factor_scores(F.col("pay_time_slot"), TIME_SLOT, weights["pay_time"]),
        "amount": factor_scores(F.col("spending_pow"), AMOUNT, weights["amount"]),
        "tname": factor_scores(F.col("tname"), BRAND, weights["tname"], BRAND_OTHER),
        "b1name": factor_scores(F.col("b1_name"), CATEGORY, weights["b1name"], CATEGORY_OTHER)})


def profile_labels(users: DataFrame, as_of: Column) -> DataFrame:
    """Age, decade of birth, zodiac sign and a default gender."""
    born = date_from_epoch_day(F.col("birthday"))
    return users.select(
        F.col("id").cast("string").alias("uid"), F.col("name").alias("uname"), "user_level", "login_name", "phone_num",
        "email", F.coalesce("gender", F.lit("home")).alias("gender"), born.alias("birthday"),
        full_years(born, as_of).cast("bigint").alias("age"), decade(born).cast("bigint").alias("decade"),
        zodiac(born).alias("zodiac_sign"))


def with_body_metrics(labels: DataFrame, metrics: DataFrame) -> DataFrame:
    return attach(labels, metrics, "uid", "uid", ["height", "unit_height", "weight", "unit_weight"])


def band_sums(scored: DataFrame, factors: Sequence[str] = tuple(WEIGHTS)) -> DataFrame:
    """Sum over all factors for each band; a factor without score counts 0."""
    total = lambda band: sum((F.coalesce(F.col(f"{f}_{band}"), F.lit(0).cast("decimal(5,3)")) for f in factors),
                             F.lit(0).cast("decimal(5,3)"))
    return scored.withColumns({f"sum_{band}": total(band).cast("decimal(8,3)") for band in BANDS})


def combine(device_search: DataFrame, orders: DataFrame) -> DataFrame:
    """Order-line scores with the same user's device and search scores, summed per band."""
    right = device_search.withColumnRenamed("uid", "_uid").drop("ts_ms")
    return band_sums(orders.join(right, orders["uid"] == right["_uid"]).drop("_uid"))


def best_band(df: DataFrame) -> Column:
    """Band with the greatest sum; the youngest wins a tie, nothing above 0 gives NULL."""
    best = F.greatest(*[F.col(f"sum_{b}") for b in BANDS])
    pick = F.lit(None).cast("string")
    for band in reversed(BANDS):
        pick = F.when(F.col(f"sum_{band}") == best, band).otherwise(pick)
    return F.when(best > 0, pick)


def label_document(combined: DataFrame, labels: DataFrame) -> DataFrame:
    """Nested label row per order line: base, log, device, calculated and extra parts."""
    base = ["decade", "zodiac_sign", "gender", "login_name", "email", "phone_num", "height", "weight", "user_level",
            "birthday", "age"]
    out = combined.join(labels.withColumnRenamed("uid", "_uid"), F.col("uid") == F.col("_uid"))
    sums = F.struct(*[F.col(f"sum_{b}").alias(f"age_sum_{b}") for b in BANDS])
    return out.select(
        "uid", "uname", "ts_ms", F.struct(*base, "judge_os").alias("user_base_label"),
        F.struct(F.col("pv").alias("intraday_pv"), "search_item").alias("user_log_label"),
        F.struct("md", "ba", "os", "ch", F.col("pay_time_slot").alias("login_time_slot")).alias("user_device_label"),
        F.struct(sums.alias("computer_age_info"), "spending_pow", best_band(out).alias("calculate_age"))
        .alias("user_calculate_label"),
        F.struct("sku_name", "b1_name", "tname", "sku_id").alias("sup_info_message"),
        F.date_format(F.timestamp_millis("ts_ms"), "yyyyMMdd").alias("ds"))
