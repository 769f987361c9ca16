"""Visitor paths through pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .ordered import in_sequence


def step_pairs(views: DataFrame, session: str, page: str, ts: str, tiebreak: Sequence[str],
               group: Sequence[str] = (), slice_seconds: int = 3600) -> DataFrame:
    """Count moves `step-n:page` -> `step-n+1:page`; the last page moves to 'null'."""
    walked = in_sequence(views.select(*dict.fromkeys([*group, session, page, ts, *tiebreak])), [*group, session],
                         ts, tiebreak, step="_n", following={"_next": page},
                         slice_seconds=slice_seconds)
    source = F.concat(F.lit("step-"), F.col("_n").cast("string"), F.lit(":"), F.col(page))
    target = F.concat(F.lit("step-"), (F.col("_n") + 1).cast("string"), F.lit(":"), F.col("_next"))
    return (walked.select(*group, source.alias("source"),
                          F.coalesce(target, F.lit("null")).alias("target"))
            .groupBy(*group, "source", "target").agg(F.count(F.lit(1)).alias("path_count")))


def page_visits(jumps: DataFrame, day: Column) -> DataFrame:
    """Each jump's source and target as visits, one per visitor, page and sequence."""
    kept = ["visitor_id", "visit_sequence", "jump_time"]
    keys = ["visitor_id", "visit_date", "page_id", "visit_sequence"]
    sides = [F.struct(F.col(f"{s}_page_id").alias("page_id"),
                      F.col(f"{s}_page_type").alias("page_type")) for s in ("source", "target")]
    visits = jumps.select(*kept, day.alias("visit_date"), F.inline(F.array(*sides)))
    # Earliest jump wins when the same page and sequence repeats on several jumps.
    return visits.groupBy(*keys).agg(F.min(F.struct("jump_time", "page_type")).alias("_v")).select(
        *keys, F.col("_v.jump_time").alias("visit_time"), F.col("_v.page_type").alias("page_type"))


_PATH_KEYS = ["visitor_id", "visit_date"]


def path_steps(visits: DataFrame, slice_seconds: int = 3600) -> DataFrame:
    """One row per step of a visitor and day, numbered in the order of the path."""
    return in_sequence(visits, _PATH_KEYS, "visit_time", ["visit_sequence", "page_id", "page_type"],
                       step="step", slice_seconds=slice_seconds)


def path_ends(steps: DataFrame) -> DataFrame:
    """Length, first and last page of each path."""
    page = F.struct("step", "page_id", "page_type")
    ends = steps.groupBy(*_PATH_KEYS).agg(F.count(F.lit(1)).alias("_n"), F.min(page).alias("_a"), F.max(page).alias("_b"))
    return ends.select(*_PATH_KEYS, (F.col("_n") - 1).alias("path_length"), *[
        F.col(f"{side}.{c}").alias(f"{name}_{c}") for side, name in (("_a", "first"), ("_b", "last")) for c in ("page_id", "page_type")])


def path_texts(steps: DataFrame, part_steps: int = 1024, arrow: str = "->") -> DataFrame:
    """Paths as text, `a->b->c`, a page without id as `null`. A path of more than `part_steps` steps continues
    in further parts, numbered from 0, so that no row grows with the path."""
    part = F.floor((F.col("step") - 1) / part_steps).alias("part")
    walked = steps.groupBy(*_PATH_KEYS, part).agg(F.array_sort(F.collect_list(F.struct("step", "page_id"))).alias("_steps"))
    names = F.transform("_steps", lambda s: F.coalesce(s["page_id"].cast("string"), F.lit("null")))
    return walked.select(*_PATH_KEYS, "part", F.array_join(names, arrow).alias("path"))
