"""Time encodings and calendar keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

DAY = "yyyy-MM-dd"
COMPACT_DAY = "yyyyMMdd"
SECOND = "yyyy-MM-dd HH:mm:ss"

# Upper hour bound (exclusive) and name of each part of the day.
DAY_SLOTS = ((6, "凌晨"), (9, "早晨"), (12, "上午"), (14, "中午"), (18, "下午"), (22, "晚上"))
LAST_SLOT = "夜间"


def from_millis(ms: Column) -> Column:
    """Epoch milliseconds (number or numeric text) to timestamp; bad text gives NULL."""
    return F.timestamp_millis(ms.try_cast("bigint"))


def millis_text(ms: Column, pattern: str = SECOND) -> Column:
    return F.date_format(from_millis(ms), pattern)


def from_iso(text: Column) -> Column:
    """`2020-01-02T03:04:05…` text to timestamp, dropping fraction and zone; bad text gives NULL."""
    return F.substring(text, 1, 19).try_cast("timestamp")


def iso_text(text: Column) -> Column:
    return F.date_format(from_iso(text), SECOND)


def compact_day(ts: Column) -> Column:
    return F.date_format(ts, COMPACT_DAY)


def day_from_compact(text: Column) -> Column:
    return F.to_date(text, COMPACT_DAY)


def date_from_epoch_day(days: Column) -> Column:
    return F.date_from_unix_date(days.cast("int"))


def week_start(day: Column) -> Column:
    """Monday of the ISO week."""
    return F.to_date(F.date_trunc("week", day))


def month_key(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def within_recent(day: Column, as_of: Column, n) -> Column:
    """True for the `n` days ending at `as_of`; day `as_of - n` is already out.

    Written as bounds on the bare day column: with a literal `as_of` they fold to
    constants, which prune day partitions and reach the file scan.
    """
    return (day <= as_of) & (day > F.date_sub(as_of, n))


def day_range(start: Column, end: Column, pattern: str = COMPACT_DAY) -> Column:
    """Array of day texts from `start` to `end`, both included."""
    return F.transform(F.sequence(start, end), lambda d: F.date_format(d, pattern))


def day_slot(ts: Column) -> Column:
    """Part of the day of a local timestamp."""
    hour = F.hour(ts)
    slot = None
    for bound, name in DAY_SLOTS:
        slot = F.when(hour < bound, name) if slot is None else slot.when(hour < bound, name)
    return F.when(ts.isNotNull(), slot.otherwise(LAST_SLOT))


def local_time(ms: Column, zone: str) -> Column:
    """Wall-clock time of epoch milliseconds in `zone` (the session runs in UTC)."""
    return F.from_utc_timestamp(from_millis(ms), zone)
