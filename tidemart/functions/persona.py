"""Age, decade, zodiac sign and spending labels."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Last day (month*100 + day) of each zodiac sign through the year.
ZODIAC_ENDS = (
    (119, "摩羯座"), (218, "水瓶座"), (320, "双鱼座"), (419, "白羊座"), (520, "金牛座"),
    (621, "双子座"), (722, "巨蟹座"), (822, "狮子座"), (922, "处女座"), (1023, "天秤座"),
    (1122, "天蝎座"), (1221, "射手座"), (1231, "摩羯座"),
)


def zodiac(birthday: Column) -> Column:
    month_day = F.month(birthday) * 100 + F.dayofmonth(birthday)
    sign = None
    for last, name in ZODIAC_ENDS:
        sign = F.when(month_day <= last, name) if sign is None else sign.when(month_day <= last, name)
    return sign


def full_years(birthday: Column, as_of: Column) -> Column:
    """Completed years of life; a leap-day birthday counts from 1 March in other years."""
    had_birthday = F.month(as_of) * 100 + F.dayofmonth(as_of) >= (
        F.month(birthday) * 100 + F.dayofmonth(birthday))
    return F.year(as_of) - F.year(birthday) - F.when(had_birthday, 0).otherwise(1)


def decade(birthday: Column) -> Column:
    return F.year(birthday) - F.year(birthday) % 10
