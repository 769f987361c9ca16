"""Members of groups, one row each: a group of any size never becomes one row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def members(df: DataFrame, keys: Sequence[str], member: Column, out: str) -> DataFrame:
    """Distinct members per key that are not NULL."""
    return df.select(*keys, member.alias(out)).dropna(subset=[out]).distinct()


def member_counts(df: DataFrame, keys: Sequence[str], member: Column, out: str) -> DataFrame:
    """Number of distinct members per key."""
    return members(df, keys, member, "_member").groupBy(*keys).agg(F.count(F.lit(1)).alias(out))
