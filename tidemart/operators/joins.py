"""Joins of facts with dimensions, dictionaries and other metrics.

No join carries a broadcast hint: Spark broadcasts a side whose size it knows to
be below the threshold, and AQE does so, or splits hot partitions, from sizes
measured at run time.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.ratios import share


def attach(fact: DataFrame, dim: DataFrame, fact_key: str | Column, dim_key: str,
           columns: Mapping[str, str] | Sequence[str], how: str = "left") -> DataFrame:
    """Bring named dimension columns to the fact. `columns`: output name -> dim column."""
    if not isinstance(columns, Mapping):
        columns = {c: c for c in columns}
    side = dim.select(F.col(dim_key).alias("_dim_key"),
                      *[F.col(src).alias(out) for out, src in columns.items()])
    key = fact[fact_key] if isinstance(fact_key, str) else fact_key
    return fact.join(side, key == side["_dim_key"], how).drop("_dim_key")


def attach_roles(fact: DataFrame, dictionary: DataFrame, code: str, name: str,
                 roles: Mapping[str, str]) -> DataFrame:
    """The same dictionary under several roles: code column -> name column to add."""
    dic = dictionary.select(F.col(code).cast("string").alias(code), name)
    for role, out in roles.items():
        fact = attach(fact, dic, F.col(role).cast("string"), code, {out: name})
    return fact


def attach_lookup(fact: DataFrame, lookup: DataFrame, fact_key: str, lookup_key: str, name: str,
                  out: str, missing: str = "N/A") -> DataFrame:
    """Left lookup where a miss becomes a visible marker."""
    return attach(fact, lookup, fact_key, lookup_key, {out: name}) \
        .withColumn(out, F.coalesce(F.col(out), F.lit(missing)))


def attach_parent(df: DataFrame, key: str, parent: str, columns: Mapping[str, str]) -> DataFrame:
    """Self join: attributes of the row that `parent` points at."""
    return attach(df, df, parent, key, columns)


def climb(df: DataFrame, tree: DataFrame, start: str, levels: Sequence[str]) -> DataFrame:
    """Walk up an (id, parent_id, name) tree from `start`, one level per name.

    Level `x` adds `x_id` and `x_name`; the walk ends in NULLs above the root.
    """
    nodes = tree.select("id", "parent_id", "name")
    at = F.col(start)
    for level in levels:
        df = attach(df.withColumn("_at", at), nodes, "_at", "id",
                    {f"{level}_id": "id", f"{level}_name": "name", "_parent": "parent_id"})
        df = df.drop("_at").withColumnRenamed("_parent", f"_parent_{level}")
        at = F.col(f"_parent_{level}")
    return df.drop(*[f"_parent_{level}" for level in levels])


def merge_metrics(keys: Sequence[str], *frames: DataFrame) -> DataFrame:
    """Full outer merge of metric tables that are unique on `keys`.

    One aggregation instead of a chain of full outer joins: NULL keys meet, rows
    are combined before the shuffle, and any number of tables costs one shuffle.
    """
    if not frames:
        raise ValueError("nothing to merge")
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    metrics = [c for c in stacked.columns if c not in keys]
    return stacked.groupBy(*keys).agg(*[F.max(c).alias(c) for c in metrics])


def share_of_group(pairs: DataFrame, group: Sequence[str], count: str, out: str,
                   digits: int = 4) -> DataFrame:
    """Each row's part of its group's total; totals are aggregated, not windowed."""
    totals = pairs.groupBy(*group).agg(F.sum(count).alias("_total")) \
        .select(*[F.col(g).alias(f"_g_{g}") for g in group], "_total")
    cond = reduce(lambda a, b: a & b,
                  [pairs[g].eqNullSafe(totals[f"_g_{g}"]) for g in group])
    joined = pairs.join(totals, cond)
    return joined.withColumn(out, share(F.col(count), F.col("_total"), digits)) \
        .drop("_total", *[f"_g_{g}" for g in group])


def prefixed(df: DataFrame, prefix: str, keep: Sequence[str] = ()) -> DataFrame:
    """Rename all columns but `keep` with a prefix, for merging two records."""
    return df.select(*[F.col(c) if c in keep else F.col(c).alias(prefix + c) for c in df.columns])
