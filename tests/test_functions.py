import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tidemart.functions import cleaning, keys, persona, promotions, ratios, timekeys


def one(spark, expr, **cells):
    types = {int: "bigint", str: "string", dt.date: "date", dt.datetime: "timestamp", Decimal: "decimal(18,4)", float: "double"}
    cols = [F.lit(v).cast(types[type(v)]).alias(k) if v is not None else F.lit(None).cast("string").alias(k)
            for k, v in cells.items()]
    return spark.range(1).select(*cols).select(expr.alias("x")).first()["x"]


@pytest.mark.parametrize("day,sign", [
    ("2000-01-19", "摩羯座"), ("2000-01-20", "水瓶座"), ("2000-02-18", "水瓶座"), ("2000-02-19", "双鱼座"), ("2000-02-29", "双鱼座"),
    ("2000-06-21", "双子座"), ("2000-06-22", "巨蟹座"), ("2000-11-22", "天蝎座"), ("2000-11-23", "射手座"),
    ("2000-12-21", "射手座"), ("2000-12-22", "摩羯座"), ("2000-12-31", "摩羯座")])
def test_zodiac_bounds(spark, day, sign):
    assert one(spark, persona.zodiac(F.col("d")), d=dt.date.fromisoformat(day)) == sign


@pytest.mark.parametrize("born,as_of,age", [
    ("2000-02-29", "2023-02-28", 22), ("2000-02-29", "2023-03-01", 23), ("2000-02-29", "2024-02-29", 24),
    ("1990-05-10", "2020-05-09", 29), ("1990-05-10", "2020-05-10", 30)])
def test_full_years(spark, born, as_of, age):
    got = one(spark, persona.full_years(F.col("b"), F.col("a")), b=dt.date.fromisoformat(born), a=dt.date.fromisoformat(as_of))
    assert got == age


@pytest.mark.parametrize("hour,slot", [(0, "凌晨"), (5, "凌晨"), (6, "早晨"), (9, "上午"), (12, "中午"), (14, "下午"), (18, "晚上"), (22, "夜间")])
def test_day_slot(spark, hour, slot):
    assert one(spark, timekeys.day_slot(F.col("t")), t=dt.datetime(2024, 1, 1, hour)) == slot


def test_recent_edges(spark):
    as_of = dt.date(2024, 1, 30)
    inside = lambda d: one(spark, timekeys.within_recent(F.col("d"), F.lit(as_of), 7), d=d)
    assert inside(dt.date(2024, 1, 24)) and inside(as_of)
    assert not inside(dt.date(2024, 1, 23)) and not inside(dt.date(2024, 1, 31))


def test_bad_times_become_null(spark):
    assert one(spark, timekeys.millis_text(F.col("m")), m="not a number") is None
    assert one(spark, timekeys.millis_text(F.col("m")), m="1700000000123") == "2023-11-14 22:13:20"
    assert one(spark, timekeys.iso_text(F.col("m")), m="2024-02-30T00:00:00Z") is None
    assert one(spark, timekeys.iso_text(F.col("m")), m="2024-02-29T01:02:03.5Z") == "2024-02-29 01:02:03"


def test_phone_and_mail(spark):
    assert one(spark, cleaning.hashed_phone(F.col("p")), p="13812345678") is not None
    assert one(spark, cleaning.hashed_phone(F.col("p")), p="1381234567") is None
    assert one(spark, cleaning.hashed_phone(F.col("p")), p="15412345678") is None
    assert one(spark, cleaning.hashed_email(F.col("p")), p="a_b@c.example.com") is not None
    assert one(spark, cleaning.hashed_email(F.col("p")), p="a b@c.com") is None
    assert len(one(spark, cleaning.hashed(F.col("p"), "salt"), p="x")) == 64


def test_star_and_codes(spark):
    assert [one(spark, cleaning.star_in_range(F.col("s")), s=v) for v in (0, 1, 5, 6)] == [3, 1, 5, 3]
    names = {"1": "home", "2": "list"}
    assert [one(spark, cleaning.code_name(F.col("c"), names, "home"), c=v) for v in ("2", "list", "x", 2)] == ["list", "list", "home", "list"]


def test_stay_needs_leave_after_visit(spark):
    a, b = dt.datetime(2024, 1, 1, 0, 0, 5), dt.datetime(2024, 1, 1, 0, 0, 9)
    assert one(spark, cleaning.stay_seconds(F.col("a"), F.col("b")), a=a, b=b) == 4
    assert one(spark, cleaning.stay_seconds(F.col("a"), F.col("b")), a=b, b=b) is None


def test_rule_text(spark):
    def text(code):
        return one(spark, promotions.rule_text(F.col("c"), promotions.COUPON_KINDS, F.lit(100), F.lit(2), F.lit(10), F.lit(8)), c=code)
    assert [text(c) for c in ("3201", "3202", "3203", "9")] == ["满100元减10元", "满2件打8 折", "减10元", None]


def test_shards(spark):
    import hashlib

    expected = "%04d" % (int(hashlib.md5(b"abc").hexdigest()[-3:], 16) % 128)
    assert one(spark, keys.shard(F.col("v")), v="abc") == expected
    assert one(spark, keys.shard_with_reserved(F.col("v")), v="0xDAC17F958D2EE523A2206206994597C13D831EC7") == "9002"


def test_share_rounds_the_decimal(spark):
    share = ratios.share(F.col("a"), F.col("b"), 2)
    assert one(spark, share, a=Decimal("50.01"), b=Decimal(6)) == 8.34
    assert one(spark, share, a=Decimal("1"), b=Decimal(0)) is None
    assert one(spark, ratios.percent(F.col("a"), F.col("b")), a=1, b=0) == 0.0
    assert one(spark, ratios.percent_value(F.col("t")), t="12.50%") == 12.5


@settings(max_examples=15, deadline=None)
@given(st.integers(0, 10_000), st.integers(1, 10_000))
def test_share_is_half_up(spark, a, b):
    from fractions import Fraction

    exact = Fraction(a, b) * 10_000
    want = int(exact + Fraction(1, 2)) / 10_000
    assert one(spark, ratios.share(F.col("a"), F.col("b"), 4), a=a, b=b) == want
