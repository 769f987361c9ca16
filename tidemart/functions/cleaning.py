"""Filters, repairs and masking used when raw rows become facts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

# Accepted formats for personal data.
PHONE_PATTERN = r"^(13[0-9]|14[01456879]|15[0-35-9]|16[2567]|17[0-8]|18[0-9]|19[0-35-9])\d{8}$"
EMAIL_PATTERN = r"^[a-zA-Z0-9_-]+@[a-zA-Z0-9_-]+(\.[a-zA-Z0-9_-]+)+$"


def live_on(day_col: str, day: str, deleted_col: str = "is_deleted") -> Column:
    """One day's snapshot without logically deleted rows; keeps the partition literal."""
    return (F.col(day_col) == F.lit(day)) & (F.col(deleted_col) == "0")


def not_deleted(deleted_col: str = "is_deleted") -> Column:
    return F.col(deleted_col) == "0"


def status_not_in(status: Column, codes: Sequence[str]) -> Column:
    return ~status.isin(list(codes)) if codes else F.lit(True)


def required(*cols: str) -> Column:
    """All columns present."""
    test = F.lit(True)
    for name in cols:
        test = test & F.col(name).isNotNull()
    return test


def terminal_is(col: Column, terminal: str) -> Column:
    return F.lower(col) == terminal.lower()


def code_name(code: Column, names: Mapping[str, str], default: str) -> Column:
    """Name of a code. Compared as text, and a value that is already a name passes."""
    text = code.cast("string")
    pairs = [F.lit(x) for kv in names.items() for x in kv]
    known = F.create_map(*pairs)
    return F.coalesce(
        F.try_element_at(known, text),
        F.when(text.isin(list(names.values())), text),
        F.lit(default),
    )


def or_default(col: Column, default, kind: str) -> Column:
    return F.coalesce(col.try_cast(kind), F.lit(default).cast(kind))


def star_in_range(star: Column, low: int = 1, high: int = 5, repair: int = 3) -> Column:
    return F.when(star.between(low, high), star).otherwise(F.lit(repair))


def hashed(col: Column, salt: str | None = None) -> Column:
    """md5 as the source tables have it; give a salt for a salted SHA-256 instead."""
    if salt is None:
        return F.md5(col.cast("string"))
    return F.sha2(F.concat(F.lit(salt), col.cast("string")), 256)


def hashed_if(col: Column, pattern: str, salt: str | None = None) -> Column:
    """Hash of a well-formed value, NULL for anything else."""
    return F.when(col.rlike(pattern), hashed(col, salt))


def hashed_phone(col: Column, salt: str | None = None) -> Column:
    return hashed_if(col, PHONE_PATTERN, salt)


def hashed_email(col: Column, salt: str | None = None) -> Column:
    return hashed_if(col, EMAIL_PATTERN, salt)


def masked_name(col: Column) -> Column:
    return F.concat(F.substring(col, 1, 1), F.lit("*"))


def stay_seconds(visit: Column, leave: Column) -> Column:
    """Seconds on a page; NULL unless the visitor left after arriving."""
    return F.when(leave > visit, F.unix_timestamp(leave) - F.unix_timestamp(visit))
