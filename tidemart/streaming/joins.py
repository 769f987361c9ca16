"""Joins of streams with streams and with dimension tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.joins import attach, prefixed
from ..sources.versions import Pins, VersionedTable


def interval_join(left: DataFrame, right: DataFrame, keys: Sequence[tuple[str, str]], left_time: str,
                  right_time: str, before: str, after: str, spread: int = 1) -> DataFrame:
    """Inner join of rows with equal keys whose times are near:
    left time - before <= right time <= left time + after.

    Both sides need a watermark; the range then bounds the state. With `spread` > 1 the
    left rows of a key are dealt over that many state partitions and the right rows are
    copied to each, for keys too busy for one.
    """
    cond = F.col(right_time).between(F.col(left_time) - F.expr(f"INTERVAL {before}"),
                                     F.col(left_time) + F.expr(f"INTERVAL {after}"))
    for a, b in keys:
        cond = cond & (F.col(a) == F.col(b))
    if spread > 1:
        left = left.withColumn("_deal", F.pmod(F.xxhash64(*[F.col(c).cast("string") for c in left.columns
                                                           if c != left_time]), F.lit(spread)))
        right = right.withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(spread - 1).cast("bigint"))))
        cond = cond & (F.col("_deal") == F.col("_copy"))
    out = left.join(right, cond)
    return out.drop("_deal", "_copy") if spread > 1 else out


def merged(left: DataFrame, right: DataFrame, keys: Sequence[tuple[str, str]], left_time: str, right_time: str,
           before: str, after: str, prefix: str = "info_") -> DataFrame:
    """Interval join that keeps every right column under a prefix."""
    named = prefixed(right, prefix)
    return interval_join(left, named, [(a, prefix + b) for a, b in keys], left_time, prefix + right_time, before, after)


def lookup(stream: DataFrame, dictionary: DataFrame, key: Column | str, dictionary_key: str, name: str, out: str,
           how: str = "inner", missing: str | None = None) -> DataFrame:
    """Dictionary name by a stream-static join. The files of the static side are listed when the stream starts,
    so rows that the dictionary gets later are not seen; `lookup_step` sees them."""
    joined = attach(stream, dictionary, key, dictionary_key, {out: name}, how)
    return joined if missing is None else joined.withColumn(out, F.coalesce(F.col(out), F.lit(missing)))


def lookup_step(dictionary: VersionedTable, pins: Pins, write: Callable[[DataFrame, int], None], key: Column | str, dictionary_key: str,
                names: dict[str, str], how: str = "left", missing: str | None = None) -> Callable[[DataFrame, int], None]:
    """Step for `runner.per_batch`: dictionary columns as of the time the batch is processed.

    The version in force is noted once per batch, so a repeated batch gives the same rows. Where the pins
    expire, names may be as old as that; a key the older version lacks is looked up in the one in force.
    `names`: output name -> dictionary column. `how`: "inner" drops rows without a match, "left" keeps
    them with NULL or `missing`.
    """
    def step(batch: DataFrame, batch_id: int) -> None:
        version, fresh = pins.pin(batch_id, dictionary.newest)
        known = dictionary.at(version).withColumn("_found", F.lit(1))
        if fresh != version:
            newer = dictionary.at(fresh).withColumn("_found", F.lit(1))
            known = known.unionByName(newer.join(known, dictionary_key, "left_anti"))
        out = attach(batch, known, key, dictionary_key, {**names, "_found": "_found"}, how)
        for name in names if missing is not None else ():
            out = out.withColumn(name, F.when(F.col("_found").isNull(), F.lit(missing)).otherwise(F.col(name)))
        write(out.drop("_found"), batch_id)

    return step


def to_folder(path: str) -> Callable[[DataFrame, int], None]:
    """Writes a batch as its own partition; a repeated batch replaces itself."""
    return lambda rows, batch_id: rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
