"""Connected components of a link table, in rounds of joins."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .store import written


def union_find(pairs: list[tuple]) -> dict:
    """Each node's smallest connected node."""
    parent: dict = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in parent}


FEW = 100_000   # links that one task may join


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over all links of a task."""
    batches = list(batches)
    if batches:
        yield from _local(iter([pa.Table.from_batches(batches).combine_chunks().to_batches()[0]]))


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over the links of one Arrow batch: one link to the root for each node."""
    for batch in batches:
        roots = union_find(list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)))
        kept = [(x, r) for x, r in roots.items() if x != r]
        yield pa.record_batch([pa.array([x for x, _ in kept], batch.schema.field(0).type),
                               pa.array([r for _, r in kept], batch.schema.field(1).type)], names=["a", "b"])


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of all nodes of the links (a, b); root is the smallest node reachable.

    Links are first shortened by union-find inside each batch. Up to FEW are then joined in one
    task. With more, every node points itself and its larger neighbours to the smallest one it
    knows (large star), then its smaller neighbours (small star), until nothing changes. A star's
    centre is met in a join or a partial minimum only, so a hot one never needs all its links in
    one task.
    """
    kind = edges.schema["a"].dataType.simpleString()
    links = written(edges.select("a", "b").mapInArrow(_local, f"a {kind}, b {kind}"), "links")
    if links.count() <= FEW:
        return written(_ended(links.coalesce(1).mapInArrow(_whole, f"a {kind}, b {kind}")), "roots")
    before = None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = written(large.where("a <> b").distinct(), "large")
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b")
        links = written(small.unionByName(low.select("a", F.col("low").alias("b"))).distinct(), "small")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return written(_ended(links), "roots")
        before = now


def _ended(links: DataFrame) -> DataFrame:
    """Links from each node to its root, and from each root to itself."""
    own = links.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(own)
