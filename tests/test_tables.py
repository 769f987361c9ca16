"""Tables switched as a whole, zip tables by end date, buckets, figures taken while writing."""

import os
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F, types as T

from tidemart.operators import observed, paths
from tidemart.operators.quality import EmptyLayer
from tidemart.sources import bucketed, switched, ziptables

DAYS = "dt date, k long"


def _days(spark, *rows):
    return spark.createDataFrame([(date(2024, 1, d), k) for d, k in rows], DAYS)


def _seen(df):
    return sorted((r.dt.day, r.k) for r in df.collect())


def test_switch_shows_a_load_whole_or_not_at_all(spark, folder, monkeypatch):
    table = switched.SwitchedTable(spark, f"{folder}/t", _days(spark).schema)
    assert table.read().count() == 0
    table.replace(_days(spark, (1, 1), (2, 2)))
    early = table.read()
    kept = table.partitions()["2024-01-01"]
    table.replace(_days(spark, (2, 3), (3, 4)))
    # A reader that began before the switch goes on with its own files.
    assert _seen(early) == [(1, 1), (2, 2)]
    assert _seen(table.read()) == [(1, 1), (2, 3), (3, 4)] and table.partitions()["2024-01-01"] == kept
    assert _seen(table.read(["2024-01-03", "2024-01-09"])) == [(3, 4)]
    with monkeypatch.context() as m:
        m.setattr(table, "_commit", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            table.replace(_days(spark, (1, 9), (2, 9)))
    assert _seen(table.read()) == [(1, 1), (2, 3), (3, 4)]
    # A manifest that was begun and never finished isn't read, and the next load goes past it.
    table.folder.write_new("_manifests/3", "2024-01-01\tload=none")
    assert _seen(table.read()) == [(1, 1), (2, 3), (3, 4)]
    table.replace(_days(spark, (1, 7)), ["2024-01-01", "2024-01-02"])
    assert _seen(table.read()) == [(1, 7), (3, 4)]
    assert len(table.vacuum(keep=1)) == 2 and _seen(table.read()) == [(1, 7), (3, 4)]


def test_switch_refuses_conflicts_and_strays(spark, folder):
    table = switched.SwitchedTable(spark, f"{folder}/t", _days(spark).schema)
    table.replace(_days(spark, (1, 1)))
    with pytest.raises(ValueError):
        table.replace(_days(spark, (1, 2), (2, 2)), ["2024-01-01"])
    other = switched.SwitchedTable(spark, f"{folder}/t", table.schema)
    commit = table._commit
    def late(number, folders):
        other.replace(_days(spark, (5, 5)))
        commit(number, folders)
    table._commit = late
    with pytest.raises(switched.LoadConflict):
        table.replace(_days(spark, (1, 3)))
    assert _seen(table.read()) == [(1, 1), (5, 5)]


LEVELS = T.StructType([T.StructField("id", T.LongType()), T.StructField("level", T.StringType())])


def _history(days):
    """The same by hand: {day: {id: level}} to the rows of the zip table."""
    open_, out = {}, []
    for day, rows in sorted(days.items()):
        for key, level in rows.items():
            if key in open_ and open_[key][0] != level:
                out.append((key, *open_[key], day - timedelta(days=1)))
            if key not in open_ or open_[key][0] != level:
                open_[key] = (level, day)
    return sorted([*out, *((k, *v, date(9999, 12, 31)) for k, v in open_.items())], key=repr)


def test_zip_table_touches_two_partitions(spark, folder):
    history = ziptables.ZipTable(spark, f"{folder}/zip", LEVELS, ["id"])
    first = date(2024, 1, 1)
    days = {first: {1: "a", 2: "a", 3: None, None: "n"}, first + timedelta(days=1): {1: "b", 2: "a"},
            first + timedelta(days=2): {1: "c", 3: "x", None: "m"}, first + timedelta(days=5): {1: "a", 4: "d"}}
    def load(day, rows):
        history.load(spark.createDataFrame([*rows.items(), *rows.items()], LEVELS), day)
    def stored(df):
        return sorted(((r.id, r.level, r.start_date, r.end_date) for r in df.collect()), key=repr)
    for day, rows in days.items():
        before = history.table.partitions()
        load(day, rows)
        after = history.table.partitions()
        changed = {v for v in before.keys() | after.keys() if before.get(v) != after.get(v)}
        assert changed <= {"9999-12-31", (day - timedelta(days=1)).isoformat()}
        assert stored(history.read()) == _history({d: r for d, r in days.items() if d <= day})
    # The last day again, the same and then corrected: what its first load closed is open again.
    load(day, rows)
    assert stored(history.read()) == _history(days)
    days[day] = {4: "e"}
    load(day, days[day])
    assert stored(history.read()) == _history(days)
    assert {r.id: r.level for r in history.as_of(first + timedelta(days=1)).collect()} == {1: "b", 2: "a", 3: None, None: "n"}
    assert {r.id: r.level for r in history.current().collect()} == {1: "c", 2: "a", 3: "x", 4: "e", None: "m"}
    with pytest.raises(ValueError):
        load(first, {1: "z"})


def test_bucketed_join_and_sum_need_no_shuffle(spark, folder):
    rows = spark.range(2000).select((F.col("id") % 300).alias("k"), "id")
    left = bucketed.write_bucketed(rows, "bucketed_left", ["k"], 4, f"{folder}/left")
    right = bucketed.write_bucketed(spark.range(300).select(F.col("id").alias("k2"), F.lit("x").alias("v")), "bucketed_right", ["k2"], 4, f"{folder}/right")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = left.join(right, F.col("k") == F.col("k2")).groupBy("k").agg(F.count("v").alias("n"), F.sum("id").alias("s"))
        assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
        got = {r.k: (r.n, r.s) for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql("DROP TABLE bucketed_left")
        spark.sql("DROP TABLE bucketed_right")
    assert got == {k: (len(range(k, 2000, 300)), sum(range(k, 2000, 300))) for k in range(300)}


def test_buckets_follow_the_size(spark):
    df = spark.range(1000)
    assert bucketed.buckets_for(df) == 1 and bucketed.buckets_for(df, 1000) == 8 and bucketed.buckets_for(df, 1, most=64) == 64


def test_figures_come_from_the_writing_job(spark, folder):
    df = spark.createDataFrame([("2024-01-01", 1, 2.5), ("2024-01-02", None, -1.0), ("2024-01-02", 3, None)], "dt string, k int, v double")
    measures = {**observed.nulls("k", "v"), **observed.bounds("v")}
    seen = observed.write_measured(df, f"{folder}/t", measures=measures)
    assert seen == {"row_count": 3, "k_nulls": 1, "v_nulls": 1, "v_min": -1.0, "v_max": 2.5}
    assert spark.read.parquet(f"{folder}/t").count() == 3 and len([n for n in os.listdir(f"{folder}/t") if n.startswith("dt=")]) == 2
    none = observed.write_measured(df.filter("k > 9"), f"{folder}/t", measures=measures)
    assert none["row_count"] == 0 and none["v_min"] is None
    with pytest.raises(EmptyLayer):
        observed.require_written(none, "t")
    both = {"low": seen, "high": none}
    assert observed.disagreements(both, {("low", "k_nulls"): ("low", "v_nulls")}) == []
    assert len(observed.disagreements(both, {("low", "row_count"): ("high", "row_count")})) == 1
    assert observed.as_rows(spark, both).count() == 10


def test_path_text_in_parts(spark):
    day = date(2024, 1, 1)
    steps = spark.createDataFrame([(7, day, n, page) for n, page in enumerate("abcde", 1)] + [(8, day, 1, None)],
                                  "visitor_id long, visit_date date, step long, page_id string")
    got = {(r.visitor_id, r.part): r.path for r in paths.path_texts(steps, 2).collect()}
    assert got == {(7, 0): "a->b", (7, 1): "c->d", (7, 2): "e", (8, 0): "null"}
