"""Ratios and rounding with one rule for empty denominators."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def share(part: Column, whole: Column, digits: int | None = None, empty=None) -> Column:
    """part / whole as double; `empty` when there is nothing to divide by.

    With `digits` the quotient is rounded half up as a decimal, so that amounts such
    as 50.01 / 6 = 8.335 round the same everywhere.
    """
    if digits is None:
        value = part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))
    else:
        quotient = part.cast("decimal(28,6)") / F.nullif(whole.cast("decimal(20,2)"), F.lit(0))
        value = F.round(quotient, digits).cast("double")
    return value if empty is None else F.coalesce(value, F.lit(float(empty)))


def percent(part: Column, whole: Column, digits: int = 2, empty=0.0) -> Column:
    return share(part * 100, whole, digits, empty)


def percent_text(value: Column, digits: int = 2) -> Column:
    """Presentation form only; keep numbers numeric until the report edge."""
    return F.when(value.isNotNull(), F.concat(F.format_string(f"%.{digits}f", value), F.lit("%")))


def percent_value(text: Column) -> Column:
    return F.replace(text, F.lit("%"), F.lit("")).try_cast("double")


def half_up(value: Column, digits: int) -> Column:
    """Round half up on the decimal, not the binary, value."""
    return F.round(value.cast(f"decimal(28,{digits + 6})"), digits)


# Bounce rules: which page view or session counts as bounced.
def short_stay(seconds: Column, limit: float, inclusive: bool = True) -> Column:
    return seconds <= limit if inclusive else seconds < limit


def bounce_rate(bounced: Column, counted: Column | None = None, digits: int = 4,
                scale: int = 1) -> Column:
    """Aggregate: bounced rows over counted rows (`scale=100` for percent)."""
    counted = F.lit(True) if counted is None else counted
    return share(F.count(F.when(bounced & counted, 1)) * scale, F.count(F.when(counted, 1)), digits)
