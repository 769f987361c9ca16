"""Keyed state, versioned lookups and restarts."""

import json
import os
import random
import time
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F, types as T
from pyspark.sql.readwriter import DataFrameWriter

from tidemart import schemas
from tidemart.sources import cdc
from tidemart.sources.upsert import UpsertTable
from tidemart.sources.versions import Pins, VersionedTable
from tidemart.streaming import bloom, dedup, dimsync, ingest, joins, keyed, logsplit, profile, runner, trade, visitors
from test_streaming import FLAGS, ROW, _changes, change, collect, stream_of

DAY = visitors.DAY_MS


class Handle:
    """The state calls that the processors use, in memory; timers fire when the test says so."""

    def __init__(self):
        self.timers, self.ttl, self.reads = set(), None, 0

    def getValueState(self, name, schema, ttlDurationMs=None):
        self.ttl = ttlDurationMs
        box = []
        return SimpleNamespace(get=lambda: box[-1] if box else None, update=lambda v: box.append(v), clear=box.clear)

    def getMapState(self, name, key, value, ttlDurationMs=None):
        cells = {}

        def get(k):
            self.reads += 1
            return cells[k]
        return SimpleNamespace(containsKey=lambda k: k in cells, getValue=get, updateValue=cells.__setitem__, removeKey=cells.pop, cells=cells)

    def registerTimer(self, at):
        self.timers.add(at)


def at(clock):
    return SimpleNamespace(getCurrentProcessingTimeInMs=lambda: clock)


def fire(processor, handle, clock):
    out = []
    for t in sorted(t for t in handle.timers if t <= clock):
        handle.timers.discard(t)
        out += list(processor.handleExpiredTimer(("k",), at(clock), SimpleNamespace(getExpiryTimeInMs=lambda t=t: t)))
    return out


# ---- last row of a processing-time window -----------------------------------------------------

def test_last_row_of_each_processing_window_by_a_manual_clock():
    schema = T.StructType().add("k", "string").add("ts", "long").add("v", "long")
    processor, handle = keyed.LastOfWindow(schema, 1000, ["ts", "v"]), Handle()
    processor.init(handle)
    rows = lambda *r: iter([pd.DataFrame([("k", *x)], columns=["k", "ts", "v"]) for x in r])
    assert list(processor.handleInputRows(("k",), rows((5, 1), (9, 2), (7, 3)), at(10_100))) == []
    assert list(processor.handleInputRows(("k",), rows((8, 4)), at(10_900))) == []           # same window, older row
    out = fire(processor, handle, 11_000)
    assert [o.iloc[0].to_dict() for o in out] == [{"k": "k", "ts": 9, "v": 2, "window_ms": 10_000}]
    assert fire(processor, handle, 99_000) == []                                            # given out once
    assert list(processor.handleInputRows(("k",), rows((1, 5)), at(12_500))) == []
    late = list(processor.handleInputRows(("k",), rows((2, 6)), at(15_000)))                # no timer ran in between
    assert [(o.ts[0], o.window_ms[0]) for o in late] == [(1, 12_000)]
    assert fire(processor, handle, 14_000) == []                                            # its late timer finds a newer window
    assert [(o.ts[0], o.window_ms[0]) for o in fire(processor, handle, 16_000)] == [(2, 15_000)]


def test_processing_windows_in_a_running_stream(spark, folder):
    batches = [[dict(k=i % 3, t=b * 10 + i, n=b) for i in range(6)] for b in range(4)]
    stream = keyed.last_per_processing_window(stream_of(spark, folder, "in", batches, ROW), "k", ["t", "n"], width_ms=200)
    query = runner.to_table(stream, f"{folder}/out", f"{folder}/check", seconds=1)
    try:
        for _ in range(60):                                                                 # until each key's last row is out
            time.sleep(1)
            rows = spark.read.schema(stream.schema).parquet(f"{folder}/out").collect() if os.path.isdir(f"{folder}/out") else []
            if {(r.k, r.t) for r in rows} >= {(2, 35), (1, 34), (0, 33)}:
                break
    finally:
        query.stop()
    given = {(r["k"], r["t"], r["n"]) for b in batches for r in b}
    assert rows and all((r.k, r.t, r.n) in given and r.window_ms % 200 == 0 for r in rows)
    assert len({(r.k, r.window_ms) for r in rows}) == len(rows)
    assert all(r.t % 10 >= 3 for r in rows)                                                 # the last of its key in its batch


# ---- newest and first ---------------------------------------------------------------------------

def random_rows(n, seed, keys=3):
    rng = random.Random(seed)
    return [(rng.randrange(keys), rng.randrange(300), i) for i in range(n)]


def test_newer_only_over_batches_and_a_restart(spark, folder):
    rows = random_rows(200, 1)
    rows += [(None, 7, 200), (None, 6, 201), (None, 9, 202), (1, None, 203)]
    parts = [rows[k:k + 51] for k in range(0, 204, 51)]
    for p in parts:
        random.Random(2).shuffle(p)
    path = f"{folder}/in"
    stream = lambda: keyed.newer_only(spark.readStream.schema(ROW).option("maxFilesPerTrigger", 1).json(path), "k", "t", "n")
    stream_of(spark, folder, "in", [[dict(zip("ktn", r)) for r in p] for p in parts[:2]], ROW)
    collect(spark, folder, stream())
    for i, p in enumerate(parts[2:], 2):
        with open(f"{path}/{i:03d}.json", "w") as f:
            f.writelines(json.dumps(dict(zip("ktn", r))) + "\n" for r in p)
        os.utime(f"{path}/{i:03d}.json", (1_700_000_000 + i, 1_700_000_000 + i))
    got = collect(spark, folder, stream())                                                  # goes on from the checkpoint
    want = dedup.newer_only_batch(spark.createDataFrame([r for r in rows if r[1] is not None], ROW), ["k"], "t", "n")
    assert sorted(map(str, got.select(*"ktn").collect())) == sorted(map(str, want.select(*"ktn").collect()))


def test_newest_time_is_kept_with_its_ttl():
    processor, handle = keyed.NewestSeen("k", "t", "n", ttl_ms=60_000), Handle()
    processor.init(handle)
    assert handle.ttl == 60_000
    rows = lambda *r: iter([pd.DataFrame([x], columns=list("ktn")) for x in r])
    assert [o.t.tolist() for o in processor.handleInputRows((1,), rows((1, 5, 1), (1, 7, 0)), at(0))] == [[7]]
    assert list(processor.handleInputRows((1,), rows((1, 7, 2)), at(0))) == []
    processor.newest.clear()                                                                # what the store does after the time
    assert [o.t.tolist() for o in processor.handleInputRows((1,), rows((1, 3, 3)), at(0))] == [[3]]


def test_cost_of_a_batch_does_not_grow(spark, folder):
    """Fifty batches of the same keys: state has one row a key, and the last batches take no longer than the first."""
    batches = [[dict(k=k, t=b, n=b * 20 + k) for k in range(20)] for b in range(50)]
    stream = keyed.newer_only(stream_of(spark, folder, "in", batches, ROW), "k", "t", "n")
    query = runner.to_table(stream, f"{folder}/out", f"{folder}/check", once=True)
    runner.finish(query)
    progress = [json.loads(p.json) if hasattr(p, "json") and isinstance(p.json, str) else p for p in query.recentProgress]
    took = [p["durationMs"]["addBatch"] for p in progress if p["numInputRows"]]
    assert progress[-1]["stateOperators"][0]["numRowsTotal"] <= 20
    assert np.median(took[-10:]) < 2 * np.median(took[5:15])
    assert spark.read.parquet(f"{folder}/out").count() == 1000


@pytest.mark.parametrize("idle", [None, 400 * DAY])
def test_new_visitor_flag_equals_the_batch_form(spark, folder, idle):
    rng = random.Random(5)
    rows = sorted((rng.randrange(9 * DAY), rng.choice(["hot"] * 5 + ["a", "b", "c"]), rng.choice("01")) for _ in range(120))
    parts = [rows[k:k + 30] for k in range(0, 120, 30)]
    for p in parts:
        rng.shuffle(p)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        stream = stream_of(spark, folder, "in", [[dict(mid=m, ts=t, is_new=f) for t, m, f in p] for p in parts], FLAGS)
        got = collect(spark, folder, keyed.repair_is_new(stream, idle)).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    batch = visitors.repair_is_new_batch(spark.createDataFrame([(m, t, f) for t, m, f in rows], FLAGS))
    assert sorted(map(tuple, got)) == sorted(map(tuple, batch.collect()))


def test_idle_device_is_forgotten_by_timer_and_by_its_next_visit():
    processor, handle = keyed.FirstDay(idle_ms=5 * DAY), Handle()
    processor.init(handle)
    visit = lambda ts, hint=False: list(processor.handleInputRows(
        ("a",), iter([pd.DataFrame([("a", ts, "1", hint)], columns=["mid", "ts", "is_new", "hint"])]), at(0)))
    assert visit(10)[0].is_new[0] == "1" and visit(2 * DAY)[0].is_new[0] == "0"
    fire(processor, handle, 5 * DAY + 11)                                                    # the first timer; a later visit came
    assert processor.first.get() is not None
    assert visit(6 * DAY)[0].is_new[0] == "0"
    fire(processor, handle, 11 * DAY + 1)
    assert processor.first.get() is None
    assert visit(12 * DAY)[0].is_new[0] == "1" and visit(30 * DAY)[0].is_new[0] == "1"       # no timer between the last two


def test_rows_without_device_or_time_keep_their_flag(spark, folder):
    rows = [dict(mid=None, ts=1, is_new="1"), dict(mid="a", ts=None, is_new="1"), dict(mid="a", ts=5, is_new=None), dict(mid="a", ts=DAY, is_new="1")]
    got = collect(spark, folder, keyed.repair_is_new(stream_of(spark, folder, "in", [rows], FLAGS))).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, [(None, 1, "1"), ("a", None, "1"), ("a", 5, None), ("a", DAY, "0")]))


# ---- Bloom filters ------------------------------------------------------------------------------

def digests(numbers):
    return [int(x).to_bytes(8, "little") * 2 if x < 0 else np.random.default_rng(int(x)).bytes(16) for x in numbers]


def test_filter_has_its_error_rate_and_forgets_nothing():
    for expected, error in ((1000, 0.01), (5000, 0.1)):
        own = bloom.Filter(expected, error)
        own.add(bloom.as_pairs(digests(range(expected))))
        assert own.may_know(bloom.as_pairs(digests(range(expected)))).all()
        wrong = own.may_know(bloom.as_pairs(digests(range(50_000, 58_000)))).mean()
        assert 0.6 * error < wrong < 1.4 * error
        assert len(own.bits) * 8 / expected < 1.5 * np.log(1 / error) / np.log(2) ** 2


def over(processor, numbers, size):
    """Numbers that pass, and how many of them were false alarms."""
    passed, alarms = [], 0
    for k in range(0, len(numbers), size):
        part = numbers[k:k + size]
        rows = pd.DataFrame({"x": part, bloom.DIGEST: digests(part), bloom.SHARD: 0})
        for out in processor.handleInputRows((0,), iter([rows.iloc[:size // 2], rows.iloc[size // 2:]]), at(0)):
            passed += out.x.tolist()
            alarms += int(out[bloom.ALARM].sum())
    return passed, alarms


@pytest.mark.parametrize("expected, error", [(7, 0.5), (100, 0.3), (5000, 0.05)])
def test_no_row_is_lost_or_doubled_whatever_the_error_rate(expected, error):
    numbers = np.random.default_rng(3).integers(0, 900, 2500).tolist()
    processor = bloom.RotatingBloom(expected, error, None)
    processor.init(Handle())
    passed, alarms = over(processor, numbers, 64)
    assert passed == list(dict.fromkeys(numbers))
    assert (alarms > 0) == (error >= 0.3)


def test_lists_are_read_only_for_alarms_and_state_per_key_is_flat():
    handle = Handle()
    processor = bloom.RotatingBloom(4000, 1e-9, None)
    processor.init(handle)
    over(processor, list(range(3000)), 500)
    size = [sum(len(v[0]) for v in m.cells.values()) for m in (processor.bits, processor.digests)]
    assert size[1] == 16 * 3000 and size[0] * 8 <= 45 * 4000
    handle.reads = 0
    over(processor, list(range(3000, 3500)), 500)
    assert handle.reads <= 3                                                                 # the filter and the list in hand, none for looking up


def test_old_generations_are_dropped():
    processor = bloom.RotatingBloom(10, 0.01, keep=2)
    processor.init(Handle())
    passed, _ = over(processor, [*range(35), 34, 33, 22, 3], 4)
    assert passed == [*range(35), 3]                                                         # generations 2 and 3 hold 20 .. 34
    assert {k[0] for k in processor.bits.cells} <= {2, 3}


def test_distinct_stream(spark, folder):
    rng = random.Random(4)
    batches = [[dict(k=rng.choice([1] * 9 + [2, 3, None]), t=rng.randrange(12), n=b) for _ in range(60)] for b in range(4)]
    out = bloom.distinct(stream_of(spark, folder, "in", batches, ROW), ["k", "t"], expected=8, error=0.4, shards=3)
    rows = collect(spark, folder, out).collect()
    assert sorted(str((r.k, r.t)) for r in rows) == sorted({str((r["k"], r["t"])) for b in batches for r in b})
    first = {}
    for b in batches:
        for r in b:
            first.setdefault((r["k"], r["t"]), r["n"])
    assert all(first[r.k, r.t] == r.n for r in rows)


# ---- versions and lookups -------------------------------------------------------------------------

DIC = T.StructType().add("id", "long").add("name", "string")


def changes_of(spark, *rows):
    return spark.createDataFrame(list(rows), "id long, name string, op string")


@pytest.mark.parametrize("fold_every", [1, 2, 100])
def test_versions_can_be_read_again(spark, folder, fold_every):
    table = VersionedTable(spark, f"{folder}/v", DIC, ["id"], fold_every=fold_every)
    assert table.newest() == -1 and table.at(-1).collect() == []
    rng, state, states = random.Random(6), {}, []
    for v in range(6):
        rows = [(k, f"{k}/{v}", rng.choice("cud")) for k in rng.sample(range(6), 3)]
        table.apply(changes_of(spark, *rows), v)
        for k, name, op in rows:
            state = {**state, k: (name, v)} if op != "d" else {x: y for x, y in state.items() if x != k}
        states.append(state)
    for v, want in enumerate(states):
        assert {r.id: (r["name"], r["version"]) for r in table.at(v).collect()} == want
    os.makedirs(f"{folder}/v/changes/9")                                                     # begun, never finished
    assert table.newest() == 5
    table.apply(changes_of(spark), 6)                                                        # an empty version
    assert {r.id for r in table.at(6).collect()} == set(states[-1])


def test_pins_answer_the_same_and_expire(spark, folder):
    clock, newest = [1000], [4]
    pins = Pins(spark, f"{folder}/p", expire_ms=100, clock=lambda: clock[0])
    read = lambda b: pins.pin(b, lambda: newest[0])
    assert read(0) == (4, 4)
    clock[0], newest[0] = 1050, 7
    assert read(0) == (4, 4) and read(1) == (4, 7)                                           # repeated; cached
    clock[0], newest[0] = 1120, 8
    assert read(2) == (8, 8) and read(1) == (4, 7)                                           # expired 100 after the reading
    assert Pins(spark, f"{folder}/p").pin(1, lambda: 99) == (4, 7)                           # also for another process
    assert Pins(spark, f"{folder}/q").pin(5, lambda: -1) == (-1, -1)


@pytest.mark.parametrize("how, missing, blank", [("left", "N/A", "N/A"), ("left", None, None), ("inner", None, "drop")])
def test_lookup_sees_what_came_between_batches(spark, folder, how, missing, blank):
    table = VersionedTable(spark, f"{folder}/dic", DIC, ["id"])
    pins = Pins(spark, f"{folder}/pins")
    look = joins.lookup_step(table, pins, joins.to_folder(f"{folder}/out"), "k", "id", {"name": "name"}, how, missing)
    writes = [[(1, "one", "c"), (2, None, "c")], [(1, "uno", "u"), (3, "three", "c")], [(1, "", "d"), (2, "two", "u")]]
    again = []

    def step(batch, batch_id):
        table.apply(changes_of(spark, *writes[batch_id]), batch_id)
        look(batch, batch_id)
        if batch_id == 1:                                                                    # the batch comes once more, after a change
            table.apply(changes_of(spark, (3, "changed", "u")), 100)
            look(batch, batch_id)
            again.append(pins.pin(1, table.newest))
    batch = [dict(k=k, t=0, n=0) for k in (1, 2, 3, None)]
    runner.finish(runner.per_batch(stream_of(spark, folder, "in", [batch] * 3, ROW), step, f"{folder}/check", once=True))
    rows = spark.read.schema("k long, name string, batch_id int").parquet(f"{folder}/out").collect()
    want = {0: {1: "one", 2: None, 3: blank, None: blank}, 1: {1: "uno", 2: None, 3: "three", None: blank}, 2: {1: blank, 2: "two", 3: "changed", None: blank}}
    assert again == [(1, 1)]
    assert {(r.batch_id, r.k, r["name"]) for r in rows} == {(b, k, v) for b, own in want.items() for k, v in own.items() if v != "drop"}


def test_expiring_lookup_serves_old_names_and_finds_new_keys(spark, folder):
    table = VersionedTable(spark, f"{folder}/dic", DIC, ["id"])
    clock = [0]
    look = joins.lookup_step(table, Pins(spark, f"{folder}/pins", 100, lambda: clock[0]), joins.to_folder(f"{folder}/out"),
                             "k", "id", {"name": "name"}, "left", "N/A")
    rows = spark.createDataFrame([(1,), (2,)], "k long")
    for b, (now, change_) in enumerate([(0, (1, "one", "c")), (50, (1, "uno", "u")), (60, (2, "two", "c")), (120, (9, "x", "c"))]):
        clock[0] = now
        table.apply(changes_of(spark, change_), b)
        look(rows, b)
    got = {(r.batch_id, r.k): r["name"] for r in spark.read.schema("k long, name string, batch_id int").parquet(f"{folder}/out").collect()}
    assert got == {(0, 1): "one", (0, 2): "N/A", (1, 1): "one", (1, 2): "N/A", (2, 1): "one", (2, 2): "two", (3, 1): "uno", (3, 2): "two"}


# ---- routes from a config stream ------------------------------------------------------------------

def test_routes_follow_a_config_stream(spark, folder):
    """Two streams with checkpoints of their own, run in turn: a route appears, is changed, vanishes and comes back."""
    config = T.StructType([*schemas.DIM_CONFIG.fields, T.StructField("ts_ms", T.LongType())])
    row = lambda table, sink, columns, op, ts: dict(source_table=table, sink_table=sink, sink_columns=columns, sink_family="info", sink_row_key="id", op=op, ts_ms=ts)
    turns = [[row("t", "dim_t", "id,a", "c", 1), row("u", "dim_u", "id", "c", 1)],
             [row("v", "dim_v", "id", "c", 2), row("u", "dim_u", "id", "d", 3), row("u", "dim_u", "id", "c", 2)],
             [row("t", "dim_t", "id,b", "u", 4)], [row("u", "dim_u", "id", "c", 5)]]
    table, store = dimsync.route_table(spark, f"{folder}/routes"), dimsync.live_store(spark, f"{folder}/rows")
    pins = Pins(spark, f"{folder}/pins")
    seen = []
    for turn, routes in enumerate(turns):
        for name, rows in (("config", routes), ("data", [change("c", s, dict(id=f"{s}{turn}", a="x", b="y"), turn) for s in "tuv"] + [change("d", "t", None, 9, dict(id="t0"))])):
            os.makedirs(f"{folder}/{name}", exist_ok=True)
            with open(f"{folder}/{name}/{turn}.json", "w") as f:
                f.writelines(json.dumps(r) + "\n" for r in rows)
        feed = spark.readStream.schema(config).json(f"{folder}/config")
        runner.finish(runner.per_batch(feed, dimsync.config_step(table), f"{folder}/c1", once=True))
        data = cdc.parse(spark.readStream.text(f"{folder}/data"))
        runner.finish(runner.per_batch(data, dimsync.live_sync_step(store, table, pins), f"{folder}/c2", once=True))
        seen.append({(r.sink_table, json.dumps(r.info, sort_keys=True)) for r in dimsync.live_rows(store, table).collect()})
    t = lambda k, c: ("dim_t", json.dumps({"id": f"t{k}", c: "x" if c == "a" else "y"}, sort_keys=True))
    u, v = lambda k: ("dim_u", json.dumps({"id": f"u{k}"})), lambda k: ("dim_v", json.dumps({"id": f"v{k}"}))
    fix = lambda rows: {(s, json.dumps(json.loads(i), sort_keys=True)) for s, i in rows}
    assert seen == [fix(x) for x in ([t(0, "a"), u(0)], [t(0, "a"), t(1, "a"), v(1)], [t(2, "b"), v(1), v(2)], [t(2, "b"), t(3, "b"), v(1), v(2), v(3), u(3)])]


# ---- failures between a step's writes and its commit -----------------------------------------------

class Failure(Exception):
    pass


def survives(monkeypatch, folder, start, read):
    """Fails after the first write, restarts, fails after the second of that run, and so on until a run ends: `start(run)`
    begins the stream of a run from its own checkpoint. The result must be that of a run without failures."""
    want = (start(f"{folder}/calm"), read(f"{folder}/calm"))[1]
    write = DataFrameWriter.parquet
    left = [0]

    def failing(self, path, *args, **kwargs):
        write(self, path, *args, **kwargs)
        left[0] -= 1
        if left[0] == 0:
            raise Failure("after a write")

    monkeypatch.setattr(DataFrameWriter, "parquet", failing)
    failures = 0
    for k in range(1, 40):
        left[0] = k
        try:
            start(f"{folder}/torn")
        except Exception as e:  # noqa: BLE001 the stream wraps what the step raises
            assert "after a write" in str(e), e
            failures += 1
            continue
        break
    monkeypatch.undo()
    assert failures >= 2
    assert read(f"{folder}/torn") == want and want


def texts(df):
    return sorted(str(r) for r in df.collect())


def test_order_detail_survives_a_failure_at_each_write(spark, folder, monkeypatch):
    changes = _changes()
    stream_of(spark, folder, "in", [changes[:9], changes[9:]])

    def start(root):
        job = trade.OrderDetailJoin(spark, f"{root}/job")
        stream = cdc.parse(spark.readStream.option("maxFilesPerTrigger", 1).text(f"{folder}/in"))
        runner.finish(runner.per_batch(stream, job.step, f"{root}/check", once=True))

    survives(monkeypatch, folder, start, lambda root: texts(trade.OrderDetailJoin(spark, f"{root}/job").result.latest()))


def _logs(n):
    return [{"common": {"uid": str(i % 3), "os": "ios 1", "ch": "c", "md": "m", "ba": "b", "mid": "x", "sid": "s"}, "page": {"page_id": "p", "item": f"w{i}", "item_type": "keyword"},
             "displays": [{"item": "1"}], "actions": [{"item": "9"}], "err": {"error_code": "1"}, "ts": i} for i in range(n)]


def test_profile_survives_a_failure_at_each_write(spark, folder, monkeypatch):
    logs = _logs(12)
    stream_of(spark, folder, "in", [logs[:5], logs[5:]])
    counts = lambda: profile.attribute_counts(profile.known_users(profile.device_and_search(ingest.page_logs(
        spark.readStream.option("maxFilesPerTrigger", 1).text(f"{folder}/in")))))

    def store(root):
        return UpsertTable(spark, f"{root}/counts", counts().schema, ["uid", "attribute", "value"], version="last_ts")

    def start(root):
        runner.finish(runner.per_batch(counts(), store(root).upsert, f"{root}/check", once=True, mode="update"))

    survives(monkeypatch, folder, start, lambda root: texts(profile.profile_rows(store(root).latest())))


def test_split_survives_a_failure_at_each_write(spark, folder, monkeypatch):
    stream_of(spark, folder, "in", [_logs(4), _logs(3)])

    def start(root):
        logs = ingest.page_logs(spark.readStream.option("maxFilesPerTrigger", 1).text(f"{folder}/in"))
        runner.finish(runner.per_batch(logs, lambda b, i: runner.write_branches(b, logsplit.split, root, i), f"{root}/check", once=True))

    survives(monkeypatch, folder, start, lambda root: [(n, texts(spark.read.parquet(f"{root}/{n}"))) for n in ("err", "display", "action", "page")])


def test_live_lookup_survives_a_failure_at_each_write(spark, folder, monkeypatch):
    """The dictionary grows between the failure and the repeated batch; the batch still reads its first version."""
    stream_of(spark, folder, "in", [[dict(k=1, t=0, n=0)], [dict(k=1, t=1, n=1), dict(k=2, t=1, n=1)]], ROW)

    def start(root):
        table = VersionedTable(spark, f"{root}/dic", DIC, ["id"])
        look = joins.lookup_step(table, Pins(spark, f"{root}/pins"), joins.to_folder(f"{root}/out"), "k", "id", {"name": "name"}, "left", "N/A")

        def step(batch, batch_id):
            if batch_id > table.newest():
                table.apply(changes_of(spark, (batch_id + 1, f"name {batch_id}", "c")), batch_id)
            look(batch, batch_id)
        runner.finish(runner.per_batch(spark.readStream.schema(ROW).option("maxFilesPerTrigger", 1).json(f"{folder}/in"), step, f"{root}/check", once=True))

    survives(monkeypatch, folder, start, lambda root: texts(spark.read.schema("k long, n long, name string").parquet(f"{root}/out").select("k", "n", "name")))


def test_rows_of_many_keys_are_thinned_without_a_call_for_each(monkeypatch):
    rows = pd.DataFrame([(k, t, n) for n, (k, t) in enumerate([(7, 5), (8, 1), (7, None), (7, 4), (None, 3), (7, 6), (None, 3), (8, 2)])], columns=list("ktn"))
    calls = []
    monkeypatch.setattr(pd.Series, "cummax", lambda *a, **b: calls.append(1))
    got = keyed.rising(rows, ["k"], "t", "n")
    assert not calls and {(k, t) for k, t in got[["k", "t"]].dropna().itertuples(index=False)} >= {(7, 5), (7, 6), (8, 1), (8, 2)}
    assert len(got[got.k.isna()]) == 1 and 3 not in got.n.tolist()[:1]


def test_newest_of_plain_rows():
    from pyspark.sql import Row
    processor, handle = keyed.NewestSeenRows("k", "t", "n"), Handle()
    processor.init(handle)
    rows = lambda *r: iter([Row(k=1, t=t, n=n) for t, n in r])
    assert [r.t for r in processor.handleInputRows((1,), rows((7, 2), (None, 1), (5, 0), (6, 3), (9, None)), at(0))] == [5, 7, 9]
    assert list(processor.handleInputRows((1,), rows((9, 5), (3, 4)), at(0))) == []
    assert [r.t for r in processor.handleInputRows((1,), rows((10, 6)), at(0))] == [10]


def test_visits_of_a_device_are_one_row_of_an_arrow_batch(spark, folder):
    rows = pd.DataFrame([("a", 9, "1"), ("a", 3, None), ("a", 3, "1"), ("b", 4, "1"), ("b", 4, "1"), ("c", 2, "0")], columns=["mid", "ts", "is_new"])
    assert [(r.mid, list(r.claims), r.begin, r.flag, r.end) for r in keyed.visits_of(rows).itertuples()] == [
        ("a", [3, 9], 3, "", 9), ("b", [4, 4], 4, "1", 4), ("c", [], 2, "0", 2)]
    batches = [[dict(mid="b", ts=-5, is_new="1")] * 2, [dict(mid="a", ts=DAY + 3, is_new="1"), dict(mid="a", ts=DAY - 1, is_new="0"), dict(mid="b", ts=-1, is_new="1"), dict(mid="b", ts=0, is_new="1")]]
    got = collect(spark, folder, keyed.repair_is_new(stream_of(spark, folder, "in", batches, FLAGS))).collect()
    assert sorted(map(tuple, got)) == [("a", DAY - 1, "0"), ("a", DAY + 3, "0"), ("b", -5, "1"), ("b", -5, "1"), ("b", -1, "1"), ("b", 0, "0")]
