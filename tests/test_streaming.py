"""Streams over several micro-batches against their batch forms."""

import json
import os
import random
from datetime import datetime

from pyspark.sql import functions as F, types as T

import __spark_entry__ as entry
from tidemart import schemas
from tidemart.bridge.tables import Inputs
from tidemart.registry.streams import as_bigint
from tidemart.sources import cdc, kafka
from tidemart.sources.upsert import UpsertTable
from tidemart.streaming import dedup, dimsync, ingest, joins, logsplit, runner, trade, visitors


def stream_of(spark, folder, name, batches, schema=None):
    """One JSON-lines file per micro-batch; without a schema each line is one text value."""
    path = os.path.join(folder, name)
    os.makedirs(path)
    for i, rows in enumerate(batches):
        file = os.path.join(path, f"{i:03d}.json")
        with open(file, "w") as f:
            f.writelines((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in rows)
        os.utime(file, (1_700_000_000 + i, 1_700_000_000 + i))
    reader = spark.readStream.option("maxFilesPerTrigger", 1)
    return reader.schema(schema).json(path) if schema else reader.text(path)


def collect(spark, folder, stream, name="out"):
    runner.finish(runner.to_table(stream, f"{folder}/{name}", f"{folder}/{name}-checkpoint", once=True), 180)
    return spark.read.schema(stream.schema).parquet(f"{folder}/{name}")


FLAGS = T.StructType([T.StructField("mid", T.StringType()), T.StructField("ts", T.LongType()), T.StructField("is_new", T.StringType())])
DAY = visitors.DAY_MS


def flags_over(spark, folder, stream, retention_ms=None):
    schema = T.StructType().add("mid", "string").add("first_day", "long").add("last_ts", "long")
    store = UpsertTable(spark, f"{folder}/first", schema, ["mid"], version="last_ts", retention_ms=retention_ms)
    runner.finish(runner.per_batch(stream, visitors.repair_is_new_step(store, f"{folder}/out"), f"{folder}/check", once=True))
    return sorted(tuple(r) for r in spark.read.schema(FLAGS).parquet(f"{folder}/out").select("mid", "ts", "is_new").collect())


def test_new_visitor_flag_over_batches(spark, folder):
    batches = [[dict(mid="a", ts=10, is_new="1"), dict(mid="b", ts=10 + DAY, is_new="0")],
               [dict(mid="a", ts=20, is_new="1"), dict(mid="a", ts=DAY + 5, is_new="1"), dict(mid="b", ts=20 + DAY, is_new="1")]]
    got = flags_over(spark, folder, stream_of(spark, folder, "in", batches, FLAGS))
    assert got == [("a", 10, "1"), ("a", 20, "1"), ("a", DAY + 5, "0"), ("b", 10 + DAY, "0"), ("b", 20 + DAY, "0")]
    batch = spark.createDataFrame([tuple(r.values()) for b in batches for r in b], FLAGS)
    assert sorted(tuple(r) for r in visitors.repair_is_new_batch(batch).collect()) == got


def test_new_visitor_flag_with_one_key_and_small_arrow_batches(spark, folder):
    rng = random.Random(5)
    rows = [("hot", n * DAY // 7 + rng.randrange(1000), rng.choice("01")) for n in range(80)]
    parts = [rows[k:k + 20] for k in range(0, 80, 20)]
    for p in parts:
        rng.shuffle(p)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10)
    try:
        got = flags_over(spark, folder, stream_of(spark, folder, "in", [[dict(zip(FLAGS.names, r)) for r in p] for p in parts], FLAGS))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == sorted(tuple(r) for r in visitors.repair_is_new_batch(spark.createDataFrame(rows, FLAGS)).collect())


def test_idle_visitor_is_forgotten(spark, folder):
    batches = [[dict(mid="a", ts=10, is_new="1")], [dict(mid="a", ts=20 * DAY, is_new="1"), dict(mid="b", ts=20 * DAY, is_new="1")]]
    got = flags_over(spark, folder, stream_of(spark, folder, "in", batches, FLAGS), retention_ms=5 * DAY)
    assert got == [("a", 10, "1"), ("a", 20 * DAY, "1"), ("b", 20 * DAY, "1")]


ROW = T.StructType([T.StructField("k", T.LongType()), T.StructField("t", T.LongType()), T.StructField("n", T.LongType())])


def newer_over(spark, folder, batches):
    schema = T.StructType().add("k", "long").add("t", "long")
    store = UpsertTable(spark, f"{folder}/newest", schema, ["k"], version="t")
    stream = stream_of(spark, folder, "in", [[dict(zip("ktn", r)) for r in b] for b in batches], ROW)
    step = dedup.newer_only_step(store, f"{folder}/out", "k", "t", "n", slice_rows=7)
    runner.finish(runner.per_batch(stream, step, f"{folder}/check", once=True))
    return sorted(tuple(r) for r in spark.read.schema(ROW).parquet(f"{folder}/out").select("k", "t", "n").collect())


def test_newer_only_over_batches(spark, folder):
    rows = [(1, 5, 0), (1, 3, 1), (1, 7, 2), (2, 1, 3), (1, 7, 4), (1, 8, 5), (2, 1, 6), (2, 2, 7)]
    want = dedup.newer_only_batch(spark.createDataFrame(rows, ROW), ["k"], "t", "n", slice_rows=2)
    got = newer_over(spark, folder, [rows[:4], rows[4:]])
    assert got == sorted(tuple(r) for r in want.collect()) == [(1, 5, 0), (1, 7, 2), (1, 8, 5), (2, 1, 3), (2, 2, 7)]


def test_newer_only_with_one_key_and_small_arrow_batches(spark, folder):
    rng = random.Random(6)
    rows = [(1, rng.randrange(300), n) for n in range(80)]
    parts = [rows[k:k + 20] for k in range(0, 80, 20)]
    for p in parts:
        rng.shuffle(p)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10)
    try:
        got = newer_over(spark, folder, parts)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    top, want = -1, []
    for r in sorted(rows, key=lambda r: r[2]):
        if r[1] > top:
            want.append(r)
        top = max(top, r[1])
    assert got == sorted(want)


def test_unreadable_messages_are_set_aside(spark):
    schema = T.StructType().add("id", "long")
    rows = spark.createDataFrame([('{"id": 1}',), ("no json",), ('{"id": "x"}',)], "value string")
    assert [r.id for r in kafka.as_records(rows, schema).collect()] == [1]
    assert {r.value for r in kafka.unreadable(rows, schema).collect()} == {"no json", '{"id": "x"}'}
    changes = spark.createDataFrame([('{"op": "c", "after": {"id": "1"}}',), ("{}",), ("x",)], "value string")
    assert cdc.parse(changes).count() == 1 and cdc.unreadable(changes).count() == 2


def test_exact_dedup_within_watermark(spark, folder):
    dicts = [dict(k=1, t=1000, n=1), dict(k=1, t=1000, n=1), dict(k=1, t=1000, n=2)]
    stream = ingest.with_event_time(stream_of(spark, folder, "in", [dicts, dicts], ROW), "t", "10 seconds")
    out = collect(spark, folder, dedup.exact(stream, ["k"], ["t", "n"]))
    assert sorted((r["k"], r["n"]) for r in out.collect()) == [(1, 1), (1, 2)]


def test_dirty_rows_and_missing_times(spark, folder):
    good = json.dumps({"common": {"mid": "m"}, "ts": 5})
    rows = spark.createDataFrame([(good,), ("no json",), ('{"common": 7}',), ('{"ts": "x"}',)], "value string")
    parsed = ingest.parse_records(rows, schemas.PAGE_LOG)
    assert [r["common"]["mid"] for r in ingest.clean(parsed).collect()] == ["m"]
    assert ingest.dirty(parsed).count() == 3
    untimed = spark.createDataFrame([(1, "5"), (2, "bad"), (3, None)], "id int, ms string")
    assert [r["id"] for r in ingest.without_event_time(untimed, "ms").collect()] == [2, 3]


def test_split_branches(spark):
    logs = [{"common": {"sid": "s"}, "page": {"page_id": "p"}, "displays": [{"item": "1"}, {"item": "2"}],
             "actions": [{"item": "9"}], "err": {"error_code": "1"}, "ts": 1},
            {"common": {"sid": "s"}, "start": {"entry": "icon"}, "displays": [{"item": "3"}], "ts": 2}]
    rows = spark.createDataFrame([(json.dumps(x),) for x in logs], "value string")
    counts = {k: v.count() for k, v in logsplit.split(ingest.page_logs(rows)).items()}
    assert counts == {"err": 1, "start": 1, "display": 2, "action": 1, "page": 1}


def test_interval_join_equals_range_join_and_spreads(spark, folder):
    left = [dict(k=i % 3, t=10**9 + i * 1000, n=i) for i in range(30)]
    right = [dict(k=i % 3, t=10**9 + i * 1000 + 500, n=i) for i in range(30)]
    results = []
    for spread in (1, 3):
        side = lambda rows, name: ingest.with_event_time(
            stream_of(spark, folder, f"{name}{spread}", [rows[:15], rows[15:]], ROW), "t", "1 hour", f"{name}_et")
        a = side(left, "a").select(F.col("k").alias("ak"), F.col("n").alias("an"), "a_et")
        b = side(right, "b").select(F.col("k").alias("bk"), F.col("n").alias("bn"), "b_et")
        out = joins.interval_join(a, b, [("ak", "bk")], "a_et", "b_et", "2 SECONDS", "4 SECONDS", spread=spread)
        rows = collect(spark, folder, out.select("an", "bn"), f"out{spread}").collect()
        results.append(sorted((r["an"], r["bn"]) for r in rows))
    want = sorted((x["n"], y["n"]) for x in left for y in right if x["k"] == y["k"] and -2000 <= y["t"] - x["t"] <= 4000)
    assert results == [want, want]


def change(op, table, after, ts, before=None):
    text = lambda m: {k: str(v) for k, v in m.items()} if m else None
    return {"op": op, "before": text(before), "after": text(after), "source": {"table": table}, "ts_ms": ts}


def _changes():
    out = []
    for o in range(6):
        out.append(change("c", "order_info", dict(id=o, user_id=o * 10, province_id=1), 1000 + o))
        for n in (1, 2):
            out.append(change("c", "order_detail", dict(
                id=f"{o}-{n}", order_id=o, sku_id=n, sku_name="s", create_time=1700000000000, sku_num=n, order_price="2.50",
                split_total_amount="1", split_activity_amount="0", split_coupon_amount="0"), 2000 + o))
        if o % 2:
            out.append(change("c", "order_detail_activity", dict(order_detail_id=f"{o}-1", activity_id=7, activity_rule_id=8), 3000 + o))
        if o % 3 == 0:
            out.append(change("c", "order_detail_coupon", dict(order_detail_id=f"{o}-2", coupon_id=9), 3000 + o))
    return out


def test_late_rows_reach_the_joined_order_lines(spark, folder):
    """Rows of one order line spread over batches in any order give the batch join."""
    all_changes = _changes()
    shuffled = all_changes[::2][::-1] + all_changes[1::2]
    batches = [shuffled[:7], shuffled[7:15], shuffled[15:]]
    job = trade.OrderDetailJoin(spark, f"{folder}/job")
    stream = cdc.parse(stream_of(spark, folder, "in", batches))
    runner.finish(runner.per_batch(stream, job.step, f"{folder}/checkpoint", once=True), 300)
    rows = cdc.parse(spark.createDataFrame([(json.dumps(c),) for c in all_changes], "value string"))
    want = trade.detail_join(trade.detail_rows(rows), trade.order_rows(rows), trade.activity_rows(rows), trade.coupon_rows(rows))
    key = lambda df: sorted(str(r.asDict()) for r in df.select(*want.columns).collect())
    assert key(job.result.latest()) == key(want)
    assert want.filter("activity_id is not null").count() == 3 and want.count() == 12


def test_cart_adds(spark):
    rows = [change("r", "cart_info", dict(id=1, sku_num=3), 1), change("u", "cart_info", dict(id=2, sku_num=5), 2, dict(sku_num=2)),
            change("u", "cart_info", dict(id=3, sku_num=1), 3, dict(sku_num=2)), change("u", "cart_info", dict(id=4, sku_num=1), 4),
            change("c", "cart_info", dict(id=5, sku_num=1), 5), change("r", "other", dict(id=6, sku_num=1), 6)]
    log = cdc.parse(spark.createDataFrame([(json.dumps(c),) for c in rows], "value string"))
    assert sorted((r["id"], r["sku_num"]) for r in trade.cart_adds(log).collect()) == [("1", 3), ("2", 3)]


def test_images_and_routes(spark, folder):
    rows = [change("d", "t", None, 1, dict(id=1)), change("u", "t", dict(id=2, a="x", b="y"), 2, dict(id=2)),
            change("c", "unrouted", dict(id=3), 3)]
    log = cdc.parse(spark.createDataFrame([(json.dumps(c),) for c in rows], "value string"))
    assert [r[0]["id"] for r in log.select(cdc.image()).collect()] == ["1", "2", "3"]
    config = spark.createDataFrame([("t", "old", "id", "info", "id", "c", 1), ("t", "dim_t", "id,a", "info", "id", "u", 2),
                                    ("unrouted", "x", "id", "info", "id", "c", 1), ("unrouted", "x", "id", "info", "id", "d", 2)],
                                   T.StructType([*schemas.DIM_CONFIG.fields, T.StructField("ts_ms", T.LongType())]))
    routed = dimsync.route(log, dimsync.current_routes(config)).collect()
    assert [(r["sink_table"], r["info"]) for r in routed] == [("dim_t", {"id": "2", "a": "x"})]


def test_routes_are_sent_to_the_changes_and_not_the_other_way_round(spark, folder):
    spark.createDataFrame([(json.dumps(dict(op="c", after={"id": "1"}, source={"table": "t"}, ts_ms=1)),)], "value string").write.parquet(f"{folder}/in")
    changes = cdc.parse(spark.read.parquet(f"{folder}/in"))
    config = spark.createDataFrame([("t", "dim_t", "id", "info", "id", "c", 1)], T.StructType([*schemas.DIM_CONFIG.fields, T.StructField("ts_ms", T.LongType())]))
    routed = dimsync.route(changes, dimsync.current_routes(config))
    plan = routed._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "BuildRight" in plan, plan
    assert [(r.sink_table, r.info) for r in routed.collect()] == [("dim_t", {"id": "1"})]


def event_table(spark, folder, rows):
    """Table `events` as a folder of files; rows: event id, time, user, type, k."""
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    made = [(i, ts, user, kind, 1.5, json.dumps({"k": k})) for i, ts, user, kind, k in rows]
    spark.createDataFrame(made, schema).repartition(3).write.parquet(f"{folder}/events.parquet")
    return folder


def test_split_of_a_table_of_several_files_whose_times_sum_beyond_bigint(spark, folder):
    late = datetime(9999, 1, 1)   # 2.5e14 ms, so 40,000 page rows sum to more than 2**63
    rows = [(i, late, 1, "click", 1) for i in range(40_000)] + [(40_000, late, 1, "view", 10)]
    got = {r.branch: (r.n, r.ts_sum) for r in entry.queries()["stream_split_logs"](spark, event_table(spark, folder, rows)).collect()}
    ms = int((late - datetime(1970, 1, 1)).total_seconds() * 1000)
    assert got == {"start": (1, ms), "page": (40_000, 40_000 * ms), "display": (40_000, 40_000 * ms), "action": (40_000, 0)}
    assert 40_000 * ms > 2 ** 63


def test_sums_that_fit_stay_bigint(spark):
    sums = spark.sql("SELECT 'a' k, CAST(9223372036854775807 AS DECIMAL(30,0)) s UNION ALL SELECT 'b', NULL")
    fits = as_bigint(sums, "s")
    assert fits.schema["s"].dataType == T.LongType() and {(r.k, r.s) for r in fits.collect()} == {("a", 2 ** 63 - 1), ("b", None)}
    wide = as_bigint(sums.withColumn("s", F.col("s") + 1), "s")
    assert {(r.k, r.s) for r in wide.collect()} == {("a", 2 ** 63), ("b", None)}


def test_batches_of_several_files_come_whole_and_in_order(spark, folder, monkeypatch):
    rows = [(i, None if i % 50 == 7 else 5 if i % 3 else i) for i in range(400)]          # two thirds share one key: some ranges are empty
    spark.createDataFrame(rows, "id long, k long").write.parquet(f"{folder}/t.parquet")
    monkeypatch.setattr(Inputs, "FILE_ROWS", 30)
    t = Inputs(spark, folder)
    spark.conf.set("spark.sql.files.openCostInBytes", 1 << 24)
    for name, stream in (("ranges", t.batches("t", "k")), ("even", t.even_batches("t", "k"))):
        seen = []

        def step(batch, batch_id):
            seen.append((batch.rdd.getNumPartitions(), [r.k or 0 for r in batch.collect()]))
        runner.finish(runner.per_batch(stream, step, f"{folder}/{name}", once=True))
        assert len(seen) == 4 and sorted(k for _, ks in seen for k in ks) == sorted(k or 0 for _, k in rows)
        ends = [(min(ks), max(ks)) for _, ks in seen if ks]
        assert all(a[1] < b[0] for a, b in zip(ends, ends[1:])) and max(n for n, _ in seen) > 1


def test_parts_of_order_lines_are_kept_as_plain_columns(spark, folder):
    """What a batch keeps while its parts are written has no maps, and gives the rows of each part."""
    changes = cdc.parse(spark.createDataFrame([(json.dumps(c),) for c in [*_changes(), change("u", "payment_info", dict(id=1), 9000)]], "value string"))
    for retention, kept in ((None, 23), (1000, 24)):                                  # with a retention the last time of all messages counts
        job = trade.OrderDetailJoin(spark, f"{folder}/{retention}", retention)
        wide = job._wide(changes)
        assert not any(isinstance(f.dataType, (T.MapType, T.ArrayType)) for f in wide.schema) and wide.count() == kept
    job = trade.OrderDetailJoin(spark, f"{folder}/job")
    job.step(changes, 0)
    for part, make in (("detail", trade.detail_rows), ("order", trade.order_rows), ("activity", trade.activity_rows), ("coupon", trade.coupon_rows)):
        rows = make(changes)
        assert sorted(map(str, job.parts[part].latest().select(*rows.columns).collect())) == sorted(map(str, rows.collect()))
