"""Choosing one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .ranking import top_per_group


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in `order`. Pruned per task before the shuffle."""
    return top_per_group(df, keys, order, 1, out="_pos", ties=False).drop("_pos")


def dedup_natural_key(df: DataFrame, keys: Sequence[str],
                      winner: Sequence[Column] | None = None) -> DataFrame:
    """Drop repeats of a natural key. Name a winner order when payloads differ."""
    if winner:
        return latest_per_key(df, keys, winner)
    return df.dropDuplicates(list(keys))
