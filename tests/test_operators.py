"""Operators against plain windows and hand-made rows, with one key holding most rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window as W, functions as F

from tidemart.operators import history, joins, latest, lists, ordered, paths, quality, ranking, recent, sets, shares
from tidemart.operators.quality import EmptyLayer


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def visits(spark):
    rng = random.Random(1)
    start = dt.datetime(2024, 1, 1)
    data = []
    for i in range(900):
        key = None if i % 50 == 0 else ("hot" if i % 3 else f"k{rng.randrange(20)}")
        data.append((i, key, start + dt.timedelta(minutes=rng.randrange(3000)), rng.choice(["a", "b", None])))
    return spark.createDataFrame(data, "id bigint, key string, ts timestamp, page string").cache()


@pytest.mark.parametrize("seconds", [60, 3600, 10 ** 9])
def test_sequence_equals_plain_window(visits, seconds):
    got = ordered.in_sequence(visits, ["key"], "ts", ["id"], step="n", following={"next_page": "page", "next_id": "id"},
                              slice_seconds=seconds)
    w = W.partitionBy("key").orderBy("ts", "id")
    want = visits.select("*", F.row_number().over(w).cast("bigint").alias("n"), F.lead("page").over(w).alias("next_page"),
                         F.lead("id").over(w).alias("next_id"))
    assert {r["id"]: r.asDict() for r in got.collect()} == {r["id"]: r.asDict() for r in want.collect()}


def test_newest_before_equals_plain_window(visits):
    rows = visits.withColumn("v", F.col("id") * 37 % 101)
    got = ordered.newest_before(rows, ["key"], "id", "v", "top", slice_rows=100)
    w = W.partitionBy("key").orderBy("id").rowsBetween(W.unboundedPreceding, -1)
    want = rows.withColumn("top", F.max("v").over(w))
    assert {r["id"]: r["top"] for r in got.collect()} == {r["id"]: r["top"] for r in want.collect()}


def test_full_rankings_equal_plain_windows(visits):
    rows = visits.select("id", F.coalesce("key", F.lit("none")).alias("key"), (F.col("id") % 7).alias("v"))
    got = ranking.ranked(rows, "v", ["id"], "rk")
    want = rows.withColumn("rk", F.rank().over(W.orderBy(F.col("v").desc())))
    assert {r["id"]: r["rk"] for r in got.collect()} == {r["id"]: r["rk"] for r in want.collect()}
    got = ranking.numbered_per_group(rows, ["key"], [F.col("v").desc(), F.col("id")], "n")
    want = rows.withColumn("n", F.row_number().over(W.partitionBy("key").orderBy(F.col("v").desc(), "id")))
    assert {r["id"]: r["n"] for r in got.collect()} == {r["id"]: r["n"] for r in want.collect()}


def test_full_ranking_has_no_single_partition_window(visits):
    """Only the one-row-per-partition offsets may be windowed in one task."""
    plan = ranking.numbered(visits.select("id"), [F.col("id")], "n")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window") == 1 and "Aggregate" in plan.split("Window", 1)[1]


def test_top_per_group_limits_before_the_shuffle(visits):
    top = ranking.top_per_group(visits, ["key"], [F.col("id").desc()], 3)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan
    assert top.groupBy("key").count().agg(F.max("count")).first()[0] == 3


def test_latest_and_dedup(visits):
    got = latest.latest_per_key(visits, ["key"], [F.col("ts").desc(), F.col("id")])
    assert got.count() == visits.select("key").distinct().count()
    again = latest.dedup_natural_key(got, ["key"])
    assert again.count() == got.count()


def test_merge_metrics_joins_null_keys(spark):
    a = spark.createDataFrame([(None, 1), ("x", 2)], "k string, a bigint")
    b = spark.createDataFrame([(None, 3), ("y", 4)], "k string, b bigint")
    got = {r["k"]: (r["a"], r["b"]) for r in joins.merge_metrics(["k"], a, b).collect()}
    assert got == {None: (1, 3), "x": (2, None), "y": (None, 4)}


def test_climb_ends_in_nulls(spark):
    tree = spark.createDataFrame([(1, 0, "country"), (2, 1, "city")], "id bigint, parent_id bigint, name string")
    start = spark.createDataFrame([(2,), (9,), (None,)], "at bigint")
    got = {r["at"]: (r["a_name"], r["b_name"], r["c_name"]) for r in joins.climb(start, tree, "at", ["a", "b", "c"]).collect()}
    assert got == {2: ("city", "country", None), 9: (None, None, None), None: (None, None, None)}


def test_share_of_group_sums_to_one(spark):
    pairs = spark.createDataFrame([("a", "x", 1), ("a", "y", 3), ("b", "x", 5)], "s string, t string, n bigint")
    got = {(r["s"], r["t"]): r["share"] for r in joins.share_of_group(pairs, ["s"], "n", "share").collect()}
    assert got == {("a", "x"): 0.25, ("a", "y"): 0.75, ("b", "x"): 1.0}


def test_recent_long_and_wide_agree(spark):
    as_of = F.lit(dt.date(2024, 3, 31))
    days = [dt.date(2024, 3, 31), dt.date(2024, 3, 25), dt.date(2024, 3, 24), dt.date(2024, 3, 2), dt.date(2024, 3, 1), dt.date(2024, 4, 1)]
    daily = spark.createDataFrame([("k", d, 1) for d in days], "k string, dt date, n bigint")
    long = {r["recent_days"]: r["n"] for r in recent.recent_long(daily, "dt", as_of, [1, 7, 30], ["k"], {"n": "n"}).collect()}
    wide = recent.recent_wide(daily, "dt", as_of, [1, 7, 30], ["k"], {"n": "n"}).first()
    assert long == {1: 1, 7: 2, 30: 4} and (wide["n_1d"], wide["n_7d"], wide["n_30d"]) == (1, 2, 4)


def test_last_seen_counts_equal_distinct_counts(visits):
    rows = visits.select(F.lit("all").alias("g"), F.col("key").alias("m"), F.to_date("ts").alias("dt"))
    as_of = F.lit(dt.date(2024, 1, 3))
    got = recent.last_seen_counts(rows, ["g"], "m", "dt", as_of, [1, 7], "n").first()
    want = rows.filter(F.col("dt") == as_of).agg(F.count_distinct("m")).first()[0]
    assert got["n_1d"] == want and got["n_7d"] == rows.filter("dt <= '2024-01-03'").agg(F.count_distinct("m")).first()[0]


def test_members(spark):
    df = spark.createDataFrame([("hot", i % 500) for i in range(3000)] + [("k", 1), ("k", 1), ("k", None)], "g string, m bigint")
    got = lists.members(df, ["g"], F.col("m"), "m").collect()
    assert sorted(r["m"] for r in got if r["g"] == "hot") == list(range(500)) and [r["m"] for r in got if r["g"] == "k"] == [1]
    assert {r["g"]: r["n"] for r in lists.member_counts(df, ["g"], F.col("m"), "n").collect()} == {"hot": 500, "k": 1}


def test_paths_of_any_length(spark):
    t = lambda m: dt.datetime(2024, 1, 1, 0, m)
    jumps = spark.createDataFrame(
        [("v", "p1", "home", "p2", "list", t(1), 1), ("v", "p2", "list", "p3", "item", t(2), 2), ("w", "p1", "home", "p1", "home", t(5), 1)],
        "visitor_id string, source_page_id string, source_page_type string, target_page_id string, target_page_type string, "
        "jump_time timestamp, visit_sequence int")
    steps = paths.path_steps(paths.page_visits(jumps, F.to_date("jump_time")), slice_seconds=30)
    assert [r["page_type"] for r in steps.filter("visitor_id = 'v'").orderBy("step").collect()] == ["home", "list", "list", "item"]
    ends = {r["visitor_id"]: r for r in paths.path_ends(steps).collect()}
    assert (ends["v"]["path_length"], ends["v"]["first_page_id"], ends["v"]["last_page_id"]) == (3, "p1", "p3")
    assert (ends["w"]["path_length"], ends["w"]["last_page_type"]) == (0, "home")


def test_equal_sort_keys_give_one_path(spark):
    """Rows equal in time and tiebreak: each step's next is the page that stands at that step."""
    t = lambda s: dt.datetime.fromtimestamp(s, dt.timezone.utc)
    views = spark.createDataFrame([("s", "a", t(3599), 0), ("s", "z", t(3600), 0), ("s", "b", t(3600), 0), ("s", "c", t(3700), 0)],
                                  "sid string, page string, ts timestamp, k int")
    got = {r["source"]: r["target"] for r in paths.step_pairs(views, "sid", "page", "ts", ["k"]).collect()}
    walk, at = [], min(got)
    while at != "null":
        walk.append(at)
        at = got[at]
    assert walk == ["step-1:a", "step-2:b", "step-3:z", "step-4:c"]


def test_step_pairs(spark):
    t = lambda m: dt.datetime(2024, 1, 1, m)
    views = spark.createDataFrame([("s", "home", t(1), 1), ("s", "item", t(5), 2), ("u", "home", t(2), 3)],
                                  "sid string, page string, ts timestamp, id bigint")
    got = rows_of(paths.step_pairs(views, "sid", "page", "ts", ["id"]))
    assert got == [("step-1:home", "null", 1), ("step-1:home", "step-2:item", 1), ("step-2:item", "null", 1)]


def test_merge_versions(spark):
    d = dt.date.fromisoformat
    old = history.open_versions(spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id bigint, v string"), F.lit(d("2024-01-01")))
    new = spark.createDataFrame([(1, "a"), (2, "B"), (4, "d")], "id bigint, v string")
    merged = history.merge_versions(old, new, ["id"], ["v"], F.lit(d("2024-02-01")))
    end = d("9999-12-31")
    assert rows_of(merged) == [
        (1, "a", d("2024-01-01"), end), (2, "B", d("2024-02-01"), end), (2, "b", d("2024-01-01"), d("2024-01-31")),
        (3, "c", d("2024-01-01"), end), (4, "d", d("2024-02-01"), end)]
    again = history.merge_versions(merged, new, ["id"], ["v"], F.lit(d("2024-02-02")))
    assert rows_of(again) == rows_of(merged)
    later = spark.createDataFrame([(1, "a"), (2, "X"), (4, "d")], "id bigint, v string")
    same_day = history.merge_versions(merged, later, ["id"], ["v"], F.lit(d("2024-02-01")))
    assert [r for r in rows_of(same_day) if r[0] == 2] == [(2, "X", d("2024-02-01"), end), (2, "b", d("2024-01-01"), d("2024-01-31"))]
    assert same_day.filter("start_date > end_date").count() == 0


def test_versions_from_changes_do_not_overlap(visits):
    out = history.versions_from_changes(visits.select("key", "ts", "id"), ["key"], "ts", ["id"])
    assert out.count() == visits.select("key", F.to_date("ts")).distinct().count()
    assert out.filter("start_date > end_date").count() == 0
    assert out.filter("end_date = '9999-12-31'").count() == visits.select("key").distinct().count()


def test_quality(spark, visits):
    with pytest.raises(EmptyLayer):
        quality.require_rows(visits.filter("id < 0"), "visits")
    row = quality.profile(visits, ["id"], ["key", "page"]).first()
    assert (row["row_count"], row["id_min"], row["id_max"], row["id_avg"]) == (900, 0.0, 899.0, 449.5)
    pairs = visits.dropna(subset=["key", "page"]).select("key", "page").distinct().count()
    assert row["pair_count"] == pairs
    checked = quality.reconcile(visits.filter("id < 100"), visits, ["page"]).collect()
    assert sum(r["upper_rows"] for r in checked) == 900 and all(r["is_equal"] == 0 for r in checked)


def test_sets_and_shares(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x")], "n bigint, s string")
    b = spark.createDataFrame([("x", 1)], "s string, n bigint")
    assert sets.union_all(a, b).count() == 3 and sets.union_distinct(a, b).count() == 1
    got = rows_of(shares.with_total_share(spark.createDataFrame([(1,), (2,)], "n bigint"), "n", "pct"))
    assert got == [(1, 33.33), (2, 66.67)]
