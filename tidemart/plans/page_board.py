"""Page traffic, click and guidance boards with scores, from a behaviour log."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.cleaning import code_name, or_default
from ..functions.keys import pick_by_modulo, pick_by_remainder
from ..functions.ratios import percent, share
from ..operators.ordered import in_sequence
from ..operators.quality import profile

# Codes of page and event types.
PAGE_TYPES = {"1": "home", "2": "item_list", "3": "item_detail", "4": "search_result", "5": "content"}
EVENT_TYPES = {"1": "view", "2": "search", "3": "add_to_cart", "4": "payment", "5": "payment_success"}
UNKNOWN_TIME = "1900-01-01 00:00:00"

# Level by divisor, age group by last digit.
USER_LEVELS = [(10, "VIP会员"), (5, "钻石会员"), (3, "金牌会员"), (2, "银牌会员")]
AGE_GROUPS = [(3, "18-25岁"), (6, "26-35岁"), (8, "36-45岁")]

# Points per unit of each score and its cap; weights and grade limits of the overall score.
TRAFFIC_POINTS = {"page_views": "0.03", "unique_visitors": "0.3", "avg_stay_duration": "2"}
BOUNCE_POINTS = "20"
CLICK_POINTS = {"click_count": "0.4", "click_users": "0.6", "conversion_clicks": "3"}
GUIDANCE_POINTS = {"guidance_rate": "0.4", "payment_users": "0.03", "payment_amount": "0.0003"}
SCORE_CAP = 100
OVERALL_WEIGHTS = {"traffic_score": "0.4", "click_score": "0.3", "guidance_score": "0.3"}
GRADES = ((85, "A"), (70, "B"), (50, "C"))
LOWEST_GRADE = "D"
UNKNOWN_SESSION = "UNKNOWN_SESSION"


def behaviour_fact(log: DataFrame) -> DataFrame:
    """Typed behaviour rows: codes as names, gaps filled with agreed values."""
    def name(col, unknown):
        return or_default(F.col(col), unknown, "string").alias(col)

    return log.select(
        "id", name("user_id", "UNKNOWN_USER"), name("session_id", UNKNOWN_SESSION), name("store_id", "UNKNOWN_STORE"),
        name("item_id", "UNKNOWN_ITEM"), code_name(F.col("page_type"), PAGE_TYPES, "home").alias("page_type"),
        code_name(F.col("event_type"), EVENT_TYPES, "view").alias("event_type"),
        F.coalesce(F.col("event_time"), F.lit(UNKNOWN_TIME).cast("timestamp")).alias("event_time"),
        F.col("search_rank").try_cast("int").alias("search_rank"), or_default(F.col("duration"), 0, "int").alias("duration"),
        or_default(F.col("is_new_customer"), 0, "int").alias("is_new_customer"),
        or_default(F.col("repurchase_flag"), 0, "int").alias("repurchase_flag"),
        or_default(F.col("acquisition_cost"), 0, "decimal(10,2)").alias("acquisition_cost"),
        or_default(F.col("rating"), 3, "int").alias("rating"),
        F.coalesce(F.col("update_time"), F.lit(UNKNOWN_TIME).cast("timestamp")).alias("update_time"),
        F.to_date("event_time").alias("dt"))


def product_dim(products: DataFrame) -> DataFrame:
    return products.select(F.col("product_id").cast("string").alias("product_id"), "product_name",
                           F.col("category_id").cast("string").alias("category_id"), "category_name",
                           F.col("price").cast("decimal(10,2)").alias("price"))


def store_dim(log: DataFrame) -> DataFrame:
    """Stores seen in the log; region is the first two characters of the id."""
    stores = log.filter(F.col("store_id").isNotNull()).groupBy("store_id").agg(
        F.min("event_time").alias("create_time"), F.max("update_time").alias("update_time"))
    return stores.select("store_id", *[F.col("store_id").alias(c) for c in ("store_name", "merchant_id", "merchant_name")],
                         F.substring("store_id", 1, 2).alias("region"), "create_time", "update_time")


def user_dim(log: DataFrame) -> DataFrame:
    """Users seen in the log; level, gender and age group follow from the numeric id."""
    users = log.filter(F.col("user_id").isNotNull()).groupBy("user_id").agg(
        F.min("event_time").alias("register_time"), F.max("event_time").alias("last_login_time"))
    number = F.col("user_id").try_cast("bigint")
    return users.select("user_id", F.col("user_id").alias("user_name"),
                        pick_by_modulo(number, USER_LEVELS, "普通会员").alias("user_level"), "register_time",
                        "last_login_time", F.when(number % 2 == 0, "男").otherwise("女").alias("gender"),
                        pick_by_remainder(number, 10, AGE_GROUPS, "46-55岁").alias("age_group"))


_KEYS = ["dt", "store_id", "page_type"]


def _is(event: str) -> Column:
    return F.col("event_type") == event


def _count(test: Column) -> Column:
    return F.count(F.when(test, 1))


def _mean(value: Column, test: Column) -> Column:
    hit = F.when(test, value)
    return F.coalesce(share(F.sum(hit), F.count(hit), 2), F.lit(0.0)).cast("decimal(16,2)")


def _traffic() -> list[Column]:
    view, search = _is("view"), _is("search")
    return [
        _count(view).alias("page_views"), F.count_distinct(F.when(view, F.col("user_id"))).alias("unique_visitors"),
        _mean(F.col("duration"), view).alias("avg_stay_duration"),
        percent(_count(view & (F.col("duration") < 10)), _count(view)).cast("decimal(16,2)").alias("bounce_rate"),
        _count(search).alias("search_count"), _mean(F.col("search_rank"), search).alias("avg_search_rank")]


def _clicks() -> list[Column]:
    view, converted = _is("view"), F.col("event_type").isin("add_to_cart", "payment")
    return [
        _count(view).alias("click_count"), F.count_distinct(F.when(view, F.col("user_id"))).alias("click_users"),
        _count(converted).alias("conversion_clicks"),
        percent(_count(converted), _count(view)).cast("decimal(16,2)").alias("conversion_rate")]


def _guidance(guided: Column, amount: str) -> list[Column]:
    view, paid = _is("view"), _is("payment")
    return [
        _count(guided).alias("to_item_detail_views"),
        percent(_count(guided), _count(view)).cast("decimal(16,2)").alias("guidance_rate"),
        F.count_distinct(F.when(paid, F.col("user_id"))).alias("payment_users"),
        F.coalesce(F.sum(F.when(paid, F.col(amount))), F.lit(0)).cast("decimal(16,2)").alias("payment_amount")]


def page_traffic(fact: DataFrame) -> DataFrame:
    return fact.groupBy(*_KEYS).agg(*_traffic())


def page_clicks(fact: DataFrame) -> DataFrame:
    return fact.groupBy(*_KEYS).agg(*_clicks())


def _with_next_page(fact: DataFrame) -> DataFrame:
    """Adds the page type of the session's next row; rows without a session aren't one walk."""
    known = F.col("session_id") != UNKNOWN_SESSION
    walked = in_sequence(fact.filter(known), ["dt", "session_id"], "event_time", ["id"], following={"_next_page": "page_type"})
    return walked.unionByName(fact.filter(~known).withColumn("_next_page", F.lit(None).cast("string")))


def _led_on() -> Column:
    return _is("view") & (F.col("page_type") != "item_detail") & (F.col("_next_page") == "item_detail")


def page_guidance(fact: DataFrame, amount: str = "acquisition_cost", by_next_page: bool = True) -> DataFrame:
    """Views that led on to a product page, and the payments made on the page.

    `by_next_page=False` counts list-page views instead, without looking ahead.
    """
    if by_next_page:
        fact, guided = _with_next_page(fact), _led_on()
    else:
        guided = _is("view") & (F.col("page_type") == "item_list")
    return fact.groupBy(*_KEYS).agg(_count(_is("view")).alias("page_views"), *_guidance(guided, amount))


def _points(weights: dict[str, str]) -> Column:
    total = None
    for col, points in weights.items():
        term = F.col(col).cast("decimal(18,2)") * F.lit(Decimal(points))
        total = term if total is None else total + term
    return total


def _capped(points: Column, active: Column) -> Column:
    cap = F.lit(Decimal(SCORE_CAP)).cast("decimal(30,6)")
    score = F.round(F.least(points.cast("decimal(30,6)"), cap), 2)
    return F.when(active, score).otherwise(F.lit(0)).cast("decimal(5,2)")


def traffic_board(days: DataFrame, bounce_points: str = BOUNCE_POINTS) -> DataFrame:
    """Traffic score. The bounce term uses 20 points per percent kept, which reaches the
    cap alone below 95 % bounces; pass "0.2" for a score that spreads out."""
    kept = (F.lit(100) - F.col("bounce_rate")) * F.lit(Decimal(bounce_points))
    active = (F.col("page_views") > 0) | (F.col("unique_visitors") > 0)
    return days.withColumn("traffic_score", _capped(_points(TRAFFIC_POINTS) + kept, active))


def click_board(days: DataFrame) -> DataFrame:
    active = (F.col("click_count") > 0) | (F.col("click_users") > 0)
    return days.withColumn("click_score", _capped(_points(CLICK_POINTS), active))


def guidance_board(days: DataFrame) -> DataFrame:
    active = (F.col("guidance_rate") > 0) | (F.col("payment_users") > 0)
    return days.withColumn("guidance_score", _capped(_points(GUIDANCE_POINTS), active))


def overall_board(fact: DataFrame, amount: str = "acquisition_cost") -> DataFrame:
    """All three scores and the grade, from one aggregation of the fact."""
    days = _with_next_page(fact).groupBy(*_KEYS).agg(*_traffic(), *_clicks(), *_guidance(_led_on(), amount))
    scores = ["traffic_score", "click_score", "guidance_score"]
    out = guidance_board(click_board(traffic_board(days))).select(*_KEYS, *scores).na.fill(0, scores)
    out = out.withColumn("overall_score", F.round(_points(OVERALL_WEIGHTS), 2).cast("decimal(5,2)"))
    grade = F.lit(LOWEST_GRADE)
    for limit, name in reversed(GRADES):
        grade = F.when(F.col("overall_score") >= limit, name).otherwise(grade)
    return out.withColumn("grade", grade)


def score_summary(board: DataFrame) -> DataFrame:
    """Value ranges of the three shown scores."""
    return profile(board, ["traffic_score", "click_score", "overall_score"])
