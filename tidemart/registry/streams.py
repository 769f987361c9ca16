"""Streaming jobs, run over the tables as file streams until all data is read."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from .. import schemas
from ..bridge.sql import CTES
from ..bridge.tables import Inputs
from ..plans import persona
from ..session import cut_lineage, scratch_path
from ..sources import cdc, kafka
from ..sources.upsert import UpsertTable
from ..sources.versions import Pins, VersionedTable
from ..streaming import bloom, dedup, dimsync, ingest, joins, keyed, logsplit, profile, runner, screening, trade, visitors
from .base import query
from .retail import log_day


# The tables hold years of history, so keyed tables are cut by year.
HISTORY_MS = 86_400_000 * 365


def run(t: Inputs, stream: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Result table of a stream after all available input."""
    root = scratch_path(t.spark, name)
    runner.finish(runner.to_table(stream, f"{root}/out", f"{root}/checkpoint", once=True, partition_by=partition_by))
    return t.spark.read.schema(stream.schema).parquet(f"{root}/out")


def run_batches(t: Inputs, stream: DataFrame, step, name: str, mode: str = "append") -> None:
    root = scratch_path(t.spark, name)
    runner.finish(runner.per_batch(stream, step, f"{root}/checkpoint", once=True, mode=mode))


def events(t: Inputs) -> DataFrame:
    return Inputs.shape_events(t.raw_stream("events"))


def log_stream(t: Inputs) -> DataFrame:
    """Log lines the way a topic delivers them: one text column."""
    return Inputs.shape_log(events(t)).select(F.col("log").alias("value"))


def changes(t: Inputs, *tables: str) -> DataFrame:
    return cdc.parse(Inputs.change_log(t.raw_stream("orders"), *tables))


def as_bigint(sums: DataFrame, column: str) -> DataFrame:
    """Exact sums as BIGINT; where one of them is too large for that, all stay decimal, so none is lost."""
    large = ~F.col(column).between(F.lit(-(1 << 63)).cast("decimal(38,0)"), F.lit((1 << 63) - 1).cast("decimal(38,0)"))
    return sums.withColumn(column, F.col(column).cast("bigint")) if sums.filter(large).isEmpty() else sums


def timed(df: DataFrame, millis: str, out: str) -> DataFrame:
    return ingest.with_event_time(df, millis, ingest.CHANGE_DELAY, out)


# ---- logs ----------------------------------------------------------------------------------

_COMMON = "ar, ba, ch, is_new, md, mid, os, sid, uid, vc"


@query("stream_clean_logs", f"SELECT {_COMMON}, page_id, ms ts FROM (SELECT * REPLACE (CASE WHEN NOT is_start THEN page_id END AS page_id) FROM log_all WHERE NOT broken)")
def _(t):
    logs = ingest.page_logs(log_stream(t))
    return run(t, logs.select("common.*", "page.page_id", "ts"), "clean")


@query("stream_dirty_logs", """SELECT '{"common": broken '||event_id AS value FROM log_all WHERE broken""")
def _(t):
    return run(t, ingest.dirty(ingest.parse_records(log_stream(t), schemas.PAGE_LOG)), "dirty")


CTES["first_visit"] = """SELECT mid, arg_min(CASE WHEN is_new='1' THEN dt ELSE dt-1 END, (ms, is_new)) first_day FROM log_all WHERE NOT broken GROUP BY mid"""
_REPAIRED = """SELECT l.mid, l.ms ts, l.event_id::VARCHAR||'' row_id, CASE WHEN is_new='1' AND dt<>first_day THEN '0' ELSE is_new END is_new
    FROM log_all l JOIN first_visit USING (mid) WHERE NOT broken"""


def _flag_rows(logs: DataFrame) -> DataFrame:
    return logs.select("common.mid", "ts", "common.is_new")


@query("stream_repair_is_new", f"SELECT mid, ts, is_new FROM ({_REPAIRED})")
def _(t):
    # Four micro-batches in the order of time, each unsorted.
    logs = Inputs.shape_log(Inputs.shape_events(t.batches("events", "ts"))).select(F.col("log").alias("value"))
    return run(t, keyed.repair_is_new(_flag_rows(ingest.page_logs(logs))), "is_new")


@query("repair_is_new_batch", f"SELECT mid, ts, is_new FROM ({_REPAIRED})")
def _(t):
    return visitors.repair_is_new_batch(_flag_rows(ingest.page_logs(t.raw_log, "log")))


@query("stream_split_logs", """SELECT branch, count(*) n, sum(ms)::BIGINT ts_sum FROM (
    SELECT 'err' branch, 0::BIGINT ms FROM log_all WHERE NOT broken AND event_type='error' UNION ALL
    SELECT 'start', ms FROM log_all WHERE is_start UNION ALL
    SELECT 'display', ms FROM page_view, range(2) r(i) WHERE i < k%3 UNION ALL
    SELECT 'action', 0::BIGINT FROM page_view WHERE k%2=1 UNION ALL
    SELECT 'page', ms FROM page_view) GROUP BY branch""")
def _(t):
    root = scratch_path(t.spark, "split")
    run_batches(t, ingest.page_logs(log_stream(t)),
                lambda batch, i: runner.write_branches(batch, logsplit.split, root, i), "split")
    parts = []
    for name in logsplit.BRANCHES:
        rows = t.spark.read.parquet(f"{root}/{name}")
        ts = F.col("ts") if "ts" in rows.columns else F.lit(0)
        parts.append(rows.select(F.lit(name).alias("branch"), ts.cast("bigint").alias("ts")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    exact = F.sum(F.col("ts").cast("decimal(20,0)")).alias("ts_sum")
    return as_bigint(cut_lineage(out.groupBy("branch").agg(F.count(F.lit(1)).alias("n"), exact), "split-sums"), "ts_sum")


@query("stream_display_rows", "SELECT sid, page_id, (k+i+1)::VARCHAR item, (i+1)::VARCHAR pos_id, ms ts FROM page_view, range(2) r(i) WHERE i < k%3")
def _(t):
    shown = logsplit.split(ingest.page_logs(log_stream(t)))["display"]
    return run(t, shown.select("common.sid", "page.page_id", F.col("display")["item"].alias("item"),
                               F.col("display")["pos_id"].alias("pos_id"), "ts"), "display")


@query("stream_exact_dedup", "SELECT DISTINCT user_id, event_type, k FROM ev")
def _(t):
    # A delay longer than the data keeps every first occurrence in state.
    kept = dedup.exact(events(t).select("ts", "user_id", "event_type", "k").withWatermark("ts", "60 days"),
                       ["user_id"], ["event_type", "k"])
    return run(t, kept.select("user_id", "event_type", "k"), "dedup")


@query("stream_bloom_distinct", "SELECT DISTINCT user_id, event_type, k FROM ev")
def _(t):
    rows = Inputs.shape_events(t.batches("events", "event_id")).select("user_id", "event_type", "k")
    return run(t, bloom.distinct(rows, ["user_id", "event_type", "k"], expected=1 << 17, shards=8).drop(bloom.ALARM), "bloom")


CTES["arrived"] = "SELECT event_id, user_id, event_type, (event_id*7919)%86400 seen FROM ev"
_NEWER = """SELECT event_id, user_id, seen FROM (SELECT *, max(seen) OVER (PARTITION BY user_id ORDER BY event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) top FROM arrived) WHERE top IS NULL OR seen>top"""


def _arrived(rows: DataFrame) -> DataFrame:
    return rows.select("event_id", "user_id", (F.col("event_id") * 7919 % 86400).alias("seen"))


@query("stream_newer_only", _NEWER)
def _(t):
    rows = _arrived(Inputs.shape_events(t.batches("events", "event_id")))
    return run(t, keyed.newer_only(rows, "user_id", "seen", "event_id"), "newer")


@query("newer_only_batch", _NEWER)
def _(t):
    return dedup.newer_only_batch(_arrived(t.events), ["user_id"], "seen", "event_id")


@query("stream_user_profile", "SELECT * FROM l_profile")
def _(t):
    counts = profile.attribute_counts(profile.known_users(profile.device_and_search(ingest.page_logs(log_stream(t)))))
    root = scratch_path(t.spark, "profile")
    store = UpsertTable(t.spark, f"{root}/counts", counts.schema, ["uid", "attribute", "value"], version="last_ts",
                        slice_ms=HISTORY_MS)
    run_batches(t, counts, store.upsert, "profile", mode="update")
    return profile.profile_rows(store.latest())


@query("stream_last_per_window", """SELECT user_id, strftime(w,'%Y-%m-%d %H:%M:%S') window_start, event_id FROM (SELECT user_id, time_bucket(INTERVAL 2 MINUTES, ts) w, event_id,
    row_number() OVER (PARTITION BY user_id, time_bucket(INTERVAL 2 MINUTES, ts) ORDER BY ts DESC, event_id DESC) r FROM ev) WHERE r=1""")
def _(t):
    rows = events(t).select("user_id", "ts", "event_id").withWatermark("ts", ingest.LOG_DELAY)
    latest = profile.last_per_window(rows, "user_id", "ts", "2 minutes")
    root = scratch_path(t.spark, "window")
    flat = latest.select("user_id", "window_start", F.unix_millis("ts").alias("ts_ms"), "event_id")
    store = UpsertTable(t.spark, f"{root}/rows", flat.schema, ["user_id", "window_start"], slice_ms=HISTORY_MS)
    run_batches(t, flat, store.upsert, "window", mode="update")
    return store.latest().select("user_id", "window_start", "event_id")


# ---- interval joins ------------------------------------------------------------------------

def _kind(t: Inputs, kind: str, prefix: str, delay: str = "3 seconds") -> DataFrame:
    rows = events(t).filter(F.col("event_type") == kind)
    return rows.select(F.col("event_id").alias(f"{prefix}_id"), F.col("user_id").alias(f"{prefix}_user"),
                       F.col("ts").alias(f"{prefix}_ts"), F.col("val").alias(f"{prefix}_val")).withWatermark(f"{prefix}_ts", delay)


def _near(a: str, b: str, span: str) -> str:
    return f"{b}.ts BETWEEN {a}.ts - INTERVAL {span} AND {a}.ts + INTERVAL {span}"


def _register_interval(name: str, span: str, spread: int = 1) -> None:
    @query(name, f"""SELECT a.event_id a_id, b.event_id b_id, a.user_id a_user FROM ev a JOIN ev b ON a.user_id=b.user_id AND {_near('a', 'b', span)}
        WHERE a.event_type='purchase' AND b.event_type='click'""")
    def _(t):
        out = joins.interval_join(_kind(t, "purchase", "a"), _kind(t, "click", "b"), [("a_user", "b_user")], "a_ts", "b_ts",
                                  span.replace("'", ""), span.replace("'", ""), spread=spread)
        return run(t, out.select("a_id", "b_id", "a_user"), "interval")


_register_interval("stream_interval_join_2min", "2 MINUTES")
_register_interval("stream_interval_join_5min", "5 MINUTES")
_register_interval("stream_interval_join_spread_6h", "6 HOURS", spread=4)


@query("stream_interval_join_chain_6h", f"""SELECT a.event_id a_id, b.event_id b_id, c.event_id c_id FROM ev a JOIN ev b ON a.user_id=b.user_id AND {_near('a', 'b', '6 HOURS')}
    JOIN ev c ON a.user_id=c.user_id AND {_near('a', 'c', '6 HOURS')} WHERE a.event_type='purchase' AND b.event_type='click' AND c.event_type='view'""")
def _(t):
    first = joins.interval_join(_kind(t, "purchase", "a"), _kind(t, "click", "b"), [("a_user", "b_user")], "a_ts", "b_ts",
                                "6 HOURS", "6 HOURS").drop("b_ts")
    both = joins.interval_join(first, _kind(t, "view", "c"), [("a_user", "c_user")], "a_ts", "c_ts", "6 HOURS", "6 HOURS")
    return run(t, both.select("a_id", "b_id", "c_id"), "chain")


@query("stream_interval_join_merged", f"""SELECT a.event_id, a.user_id, b.event_id info_event_id, b.val::DOUBLE info_val FROM ev a JOIN ev b ON a.user_id=b.user_id
    AND {_near('a', 'b', '1 HOUR')} WHERE a.event_type='purchase' AND b.event_type='signup'""")
def _(t):
    side = lambda kind: events(t).filter(F.col("event_type") == kind).select("event_id", "user_id", "ts", "val") \
        .withWatermark("ts", ingest.CHANGE_DELAY)
    out = joins.merged(side("purchase"), side("signup"), [("user_id", "user_id")], "ts", "ts", "1 HOUR", "1 HOUR")
    return run(t, out.select("event_id", "user_id", "info_event_id", "info_val"), "merged")


# ---- change log ----------------------------------------------------------------------------

CTES.update({
    "c_line": """SELECT o_orderkey||'-'||n id, o_orderkey, o_orderkey::VARCHAR order_id, (o_orderkey*7%1000+n)::VARCHAR sku_id, 'sku '||n sku_name, n,
        epoch_ms(ordered) ms, n::VARCHAR sku_num, (n*total)::DECIMAL(16,2)::VARCHAR split_original_amount, total::VARCHAR split_total_amount,
        (o_orderkey%11)::VARCHAR split_activity_amount, (o_orderkey%13)::VARCHAR split_coupon_amount, o_custkey::VARCHAR user_id, (o_custkey%25)::VARCHAR province_id,
        CASE WHEN n=1 AND o_orderkey%2=0 THEN (o_orderkey%6)::VARCHAR END activity_id, CASE WHEN n=1 AND o_orderkey%2=0 THEN (o_orderkey%25)::VARCHAR END activity_rule_id,
        CASE WHEN n=2 AND o_orderkey%3=1 THEN (o_orderkey%25)::VARCHAR END coupon_id, epoch_ms(ordered)+n*2000 ts_ms, o_orderstatus, total, ordered
        FROM heads, range(1,4) r(n) WHERE n <= o_orderkey%3+1""",
    "c_dic": "SELECT dic_code, dic_name FROM dictionary",
})
_LINE = "order_id, user_id, sku_id, province_id, activity_id, activity_rule_id, coupon_id, sku_num, split_original_amount, split_activity_amount, split_coupon_amount"


def published_lines(t: Inputs) -> DataFrame:
    """Stream of the order lines that the detail job has published, with user and province."""
    job = trade.OrderDetailJoin(t.spark, scratch_path(t.spark, "order_detail"), slice_ms=HISTORY_MS)
    run_batches(t, changes(t), job.step, "order_detail")
    return job.result.stream()


@query("stream_cdc_mirror", """SELECT 'order_detail' AS "table", count(*) n FROM c_line UNION ALL SELECT 'order_info', count(*) FROM heads UNION ALL
    SELECT 'order_detail_activity', count(*) FROM heads WHERE o_orderkey%2=0 UNION ALL SELECT 'order_detail_coupon', count(*) FROM heads WHERE o_orderkey%3=1 UNION ALL
    SELECT 'payment_info', count(*) FROM heads WHERE o_orderstatus='F' UNION ALL SELECT 'order_refund_info', count(*) FROM heads WHERE o_orderstatus='O' UNION ALL
    SELECT 'refund_payment', count(*) FROM heads WHERE o_orderstatus='O' AND o_orderkey%2=0""")
def _(t):
    mirrored = run(t, Inputs.change_log(t.raw_stream("orders")), "mirror")
    return cdc.parse(mirrored).groupBy(F.col("source")["table"].alias("table")).agg(F.count(F.lit(1)).alias("n"))


@query("stream_cart_adds", """SELECT event_id::VARCHAR id, user_id::VARCHAR user_id, k::VARCHAR sku_id, CASE WHEN event_id%3=0 THEN event_id%7+1 ELSE event_id%7+1-event_id%5 END sku_num,
    epoch_us(ts)//1000 ts_ms FROM ev WHERE event_type='signup' AND (event_id%3=0 OR (event_id%3=1 AND event_id%7+1 > event_id%5))""")
def _(t):
    return run(t, trade.cart_adds(Inputs.cart_changes(t.raw_stream("events"))), "cart")


@query("stream_order_detail", f"""SELECT id, {_LINE}, split_total_amount, sku_name, ms::VARCHAR create_time, strftime(ordered,'%Y-%m-%d') date_id, ts_ms FROM c_line""")
def _(t):
    job = trade.OrderDetailJoin(t.spark, scratch_path(t.spark, "order_detail"), slice_ms=HISTORY_MS)
    run_batches(t, changes(t), job.step, "order_detail")
    return job.result.latest()


@query("stream_order_cancel", f"""SELECT id, {_LINE}, split_total_amount,
    strftime(ordered + INTERVAL 2 HOUR,'%Y-%m-%d') date_id, (ms+7200000)::VARCHAR operate_time, ms ts_ms FROM c_line WHERE o_orderstatus='P'""")
def _(t):
    out = trade.cancelled_lines(published_lines(t), trade.cancellations(changes(t, "order_info")), timed, "30 MINUTES", "30 MINUTES")
    return run(t, out, "cancel")


@query("stream_payment_success", f"""SELECT id order_detail_id, {_LINE},
    md5(d.dic_code) payment_type_code, d.dic_name payment_type_name, (ms+7200000)::VARCHAR callback_time, split_total_amount split_payment_amount, ms+o_orderkey%10*1000 ts_ms
    FROM c_line JOIN c_dic d ON d.dic_code='110'||(o_orderkey%6+1) WHERE o_orderstatus='F' AND abs(n*2000 - o_orderkey%10*1000) <= 5000""")
def _(t):
    dic = trade.keyed_dictionary(t.dictionary)
    out = trade.paid_lines(trade.payments(changes(t, "payment_info")), published_lines(t), dic, timed)
    return run(t, out, "payment")


@query("stream_refund_request", """SELECT (o_orderkey+1)::VARCHAR id, o_custkey::VARCHAR user_id, o_orderkey::VARCHAR order_id, (o_orderkey%1000)::VARCHAR sku_id, (o_custkey%25)::VARCHAR province_id,
    strftime(ordered + INTERVAL 2 HOUR,'%Y-%m-%d') date_id, (epoch_ms(ordered)+7200000)::VARCHAR create_time, md5(a.dic_code) refund_type_code, a.dic_name refund_type_name,
    md5(b.dic_code) refund_reason_type_code, b.dic_name refund_reason_type_name, 'reason' refund_reason_txt, (o_orderkey%3+1)::VARCHAR refund_num, total::VARCHAR refund_amount,
    epoch_ms(ordered)+60000 ts_ms FROM heads JOIN c_dic a ON a.dic_code='150'||(o_orderkey%5+1) JOIN c_dic b ON b.dic_code='130'||(o_orderkey%6+1) WHERE o_orderstatus='O'""")
def _(t):
    dic = trade.keyed_dictionary(t.dictionary)
    out = trade.requested_refunds(trade.refund_requests(changes(t, "order_refund_info")), trade.order_rows(changes(t, "order_info")), dic, timed,
                                  "30 MINUTES", "30 MINUTES")
    return run(t, out, "refund")


def _paid_refund_sql(how: str) -> str:
    return f"""SELECT (o_orderkey+7)::VARCHAR id, o_custkey::VARCHAR user_id, o_orderkey::VARCHAR order_id, (o_orderkey%1000)::VARCHAR sku_id, (o_custkey%25)::VARCHAR province_id,
        md5('110'||(o_orderkey%6+1)) payment_type_code, d.dic_name payment_type_name, strftime(ordered + INTERVAL 2 HOUR,'%Y-%m-%d') date_id,
        (epoch_ms(ordered)+7200000)::VARCHAR callback_time, (o_orderkey%3+1)::VARCHAR refund_num, total::VARCHAR total_amount, epoch_ms(ordered)+120000 ts_ms
        FROM heads {how} JOIN c_dic d ON d.dic_code='110'||(o_orderkey%6+1) WHERE o_orderstatus='O' AND o_orderkey%2=0 AND o_orderkey%3<>0"""


def _register_paid_refund(name: str, how: str) -> None:
    @query(name, _paid_refund_sql(how))
    def _(t):
        dic = trade.keyed_dictionary(t.dictionary)
        out = trade.paid_refunds(trade.refund_payments(changes(t, "refund_payment")), trade.finished_refunds(changes(t, "order_refund_info")),
                                 trade.refunded_orders(changes(t, "order_info")), dic, timed, "30 MINUTES", "30 MINUTES", names=how.lower())
        return run(t, out, "paid_refund")


_register_paid_refund("stream_refund_paid", "INNER")
_register_paid_refund("stream_refund_paid_left_names", "LEFT")


CTES["c_comment"] = """SELECT doc_id::VARCHAR id, (doc_id%100)::VARCHAR user_id, (doc_id%50)::VARCHAR sku_id, text comment_txt, md5('120'||(doc_id%6+1)) appraise,
    d.dic_name appraise_name, doc_id*1000 ts_ms FROM documents JOIN c_dic d ON d.dic_code='120'||(doc_id%6+1)"""


def comment_stream(t: Inputs) -> DataFrame:
    log = Inputs.comment_changes(t.raw_stream("documents"))
    return trade.comments(log, trade.keyed_dictionary(t.dictionary))


@query("stream_comments", "SELECT * FROM c_comment")
def _(t):
    return run(t, comment_stream(t), "comments")


CTES["listed"] = "SELECT DISTINCT string_split(text, ',')[-1] word FROM documents JOIN labels USING (doc_id) WHERE toxic=1"
_SCREEN = """SELECT id, user_id, md5(comment_txt) comment_md5, CASE WHEN w.word IS NOT NULL THEN 1 ELSE 0 END::BIGINT is_violation,
    CASE WHEN w.word IS NOT NULL THEN 'P0' ELSE '' END violation_grade, coalesce(w.word,'') violation_msg
    FROM c_comment LEFT JOIN listed w ON w.word=string_split(comment_txt, ',')[-1]"""


def _screened(df: DataFrame) -> DataFrame:
    return df.select("id", "user_id", F.md5("comment_txt").alias("comment_md5"), "is_violation", "violation_grade", "violation_msg")


@query("stream_screen_comments", _SCREEN)
def _(t):
    return run(t, _screened(screening.screen(comment_stream(t), t.listed_words)), "screen")


@query("screen_conversations", """SELECT conv_id, turn, CASE WHEN w.word IS NOT NULL THEN 1 ELSE 0 END::BIGINT is_violation, CASE WHEN w.word IS NOT NULL THEN 'P0' ELSE '' END violation_grade,
    coalesce(w.word,'') violation_msg FROM conversations c LEFT JOIN listed w ON w.word=string_split(c.text, ',')[-1]""")
def _(t):
    return screening.screen(t.raw("conversations"), t.listed_words, text="text").drop("text", "role")


@query("stream_lookup_or_missing", """SELECT event_id, coalesce(p.pos_location,'N/A') place FROM ev LEFT JOIN promotion_pos p ON p.id=ev.k""")
def _(t):
    out = joins.lookup(events(t), t.promotion_pos, "k", "id", "pos_location", "place", how="left", missing="N/A")
    return run(t, out.select("event_id", "place"), "lookup")


# Positions that change while the stream runs: a version comes before each of its four batches.
CTES.update({
    "pos_change": """SELECT * FROM (SELECT n_nationkey::BIGINT id, v, CASE WHEN v=0 THEN 'c' WHEN (n_nationkey+v)%5=0 THEN 'd' WHEN (n_nationkey+v)%3=0 THEN 'u' END op,
        CASE WHEN v=0 THEN n_name ELSE n_name||'/'||v END place FROM nation, range(4) r(v)) WHERE op IS NOT NULL""",
    "ev_placed": "SELECT *, (event_id-(SELECT min(event_id) FROM ev))*4//((SELECT max(event_id)-min(event_id)+1 FROM ev)) v FROM ev",
    "ev_pos": """SELECT e.event_id, e.v, arg_max(p.op, p.v) op, arg_max(p.place, p.v) place FROM ev_placed e LEFT JOIN pos_change p ON p.id=e.k AND p.v<=e.v GROUP BY e.event_id, e.v""",
})
_AS_OF = "SELECT event_id, CASE WHEN op IS NULL OR op='d' THEN {} ELSE place END place FROM ev_pos"


def _position_changes(t: Inputs) -> DataFrame:
    n, v = F.col("n_nationkey").cast("bigint"), F.col("v")
    op = F.when(v == 0, "c").when((n + v) % 5 == 0, "d").when((n + v) % 3 == 0, "u")
    rows = t.raw("nation").withColumn("v", F.explode(F.array(*[F.lit(k) for k in range(4)])))
    return rows.select(n.alias("id"), "v", op.alias("op"), F.when(v == 0, F.col("n_name")).otherwise(F.concat_ws("/", "n_name", v)).alias("place")) \
        .filter(F.col("op").isNotNull())


def _register_as_of(name: str, how: str, missing: str | None, sql: str) -> None:
    @query(name, sql)
    def _(t):
        root, given = scratch_path(t.spark, "as_of"), _position_changes(t)
        positions = VersionedTable(t.spark, f"{root}/positions", given.drop("v", "op").schema, ["id"], fold_every=2)
        stream = t.even_batches("events", "event_id")
        rows = stream.select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"))
        look = joins.lookup_step(positions, Pins(t.spark, f"{root}/pins"), joins.to_folder(f"{root}/out"), "k", "id", {"place": "place"}, how, missing)

        def step(batch: DataFrame, batch_id: int) -> None:
            positions.apply(given.filter(F.col("v") == batch_id).drop("v"), batch_id)   # what another job writes between two batches
            look(batch, batch_id)

        run_batches(t, rows, step, "as_of")
        return t.spark.read.schema("event_id long, k long, place string").parquet(f"{root}/out").select("event_id", "place")


_register_as_of("stream_lookup_as_of", "left", "N/A", _AS_OF.format("'N/A'"))
_register_as_of("stream_lookup_as_of_left", "left", None, _AS_OF.format("NULL"))
_register_as_of("stream_lookup_as_of_inner", "inner", None, f"SELECT * FROM ({_AS_OF.format('NULL')}) WHERE place IS NOT NULL")


# ---- dimension sync ------------------------------------------------------------------------

def routes(t: Inputs) -> DataFrame:
    """Routing rows in force; the last one was deleted again."""
    rows = [("order_info", "dim_order", "id,order_status,province_id", "info", "id", "r", 1),
            ("payment_info", "dim_payment", "order_id,payment_type", "info", "order_id", "c", 1),
            ("order_detail", "dim_detail", "id", "info", "id", "c", 1), ("order_detail", "dim_detail", "id", "info", "id", "d", 2)]
    schema = T.StructType([*schemas.DIM_CONFIG.fields, T.StructField("ts_ms", T.LongType())])
    return dimsync.current_routes(t.spark.createDataFrame(rows, schema))


@query("stream_dimension_sync", """SELECT 'dim_order' sink_table, md5(o_orderkey::VARCHAR) row_key, o_orderkey||'|'||CASE o_orderstatus WHEN 'F' THEN '1002' WHEN 'P' THEN '1003' ELSE '1006' END
    ||'|'||(o_custkey%25) info, epoch_ms(ordered) ts_ms FROM heads UNION ALL
    SELECT 'dim_payment', md5(o_orderkey::VARCHAR), o_orderkey||'|110'||(o_orderkey%6+1), epoch_ms(ordered)+o_orderkey%10*1000 FROM heads WHERE o_orderstatus='F'""")
def _(t):
    store = dimsync.dimension_store(t.spark, scratch_path(t.spark, "dims"), HISTORY_MS)
    run_batches(t, changes(t), dimsync.sync_step(store, lambda: routes(t)), "dims")
    cells = [F.try_element_at(F.col("info"), F.lit(c)) for c in ("id", "order_id", "order_status", "payment_type", "province_id")]
    return store.latest().withColumn("info", F.concat_ws("|", *cells))


CTES.update({
    "head_placed": "SELECT *, (o_orderkey-(SELECT min(o_orderkey) FROM orders))*4//((SELECT max(o_orderkey)-min(o_orderkey)+1 FROM orders)) v FROM heads",
    "sink": "SELECT r_regionkey i, 'dim_'||lower(replace(r_name,' ','_')) sink_table FROM region",
})

#: Source table, and for each version that changes its route: operation, columns, key. One row of `region` per route.
_ROUTES = [("order_info", {0: ("c", "id,order_status,province_id", "id")}), ("payment_info", {1: ("c", "order_id,payment_type", "order_id")}),
           ("order_detail", {0: ("c", "id", "id"), 2: ("d", "id", "id")}),
           ("order_refund_info", {0: ("c", "id", "id"), 2: ("u", "order_id,refund_num", "id")}),
           ("refund_payment", {0: ("c", "order_id", "id"), 1: ("d", "order_id", "id"), 3: ("c", "order_id", "id")})]


def _route_changes(t: Inputs) -> DataFrame:
    """Config changes by version: routes appear, change, vanish and come back while the stream runs."""
    rows = [(i, v, table, columns, key, op) for i, (table, steps) in enumerate(_ROUTES) for v, (op, columns, key) in steps.items()]
    given = t.spark.createDataFrame(rows, "i int, v int, source_table string, sink_columns string, sink_row_key string, op string")
    sink = F.concat(F.lit("dim_"), F.lower(F.replace("r_name", F.lit(" "), F.lit("_"))))
    return given.join(t.raw("region"), F.col("i") == F.col("r_regionkey")).select(
        "source_table", sink.alias("sink_table"), "sink_columns", F.lit("info").alias("sink_family"), "sink_row_key", "op",
        F.col("v").cast("long").alias("ts_ms"), "v")


@query("stream_live_routes", """SELECT sink_table, md5(key) row_key, info, ts_ms FROM (
    SELECT 0 i, o_orderkey::VARCHAR AS "key", o_orderkey||'|'||CASE o_orderstatus WHEN 'F' THEN '1002' WHEN 'P' THEN '1003' ELSE '1006' END||'|'||(o_custkey%25) info,
        epoch_ms(ordered) ts_ms FROM head_placed UNION ALL
    SELECT 1, o_orderkey::VARCHAR, o_orderkey||'|110'||(o_orderkey%6+1), epoch_ms(ordered)+o_orderkey%10*1000 FROM head_placed WHERE o_orderstatus='F' AND v>=1 UNION ALL
    SELECT 3, (o_orderkey+1)::VARCHAR, o_orderkey||'|'||(o_orderkey%3+1), epoch_ms(ordered)+60000 FROM head_placed WHERE o_orderstatus='O' AND v>=2 UNION ALL
    SELECT 4, (o_orderkey+7)::VARCHAR, o_orderkey::VARCHAR, epoch_ms(ordered)+120000 FROM head_placed WHERE o_orderstatus='O' AND o_orderkey%2=0 AND v>=3) JOIN sink USING (i)""")
def _(t):
    root, given = scratch_path(t.spark, "live"), _route_changes(t)
    table = dimsync.route_table(t.spark, f"{root}/routes")
    configure = dimsync.config_step(table)
    store = dimsync.live_store(t.spark, f"{root}/rows", HISTORY_MS)
    sync = dimsync.live_sync_step(store, table, Pins(t.spark, f"{root}/pins"))

    def step(batch: DataFrame, batch_id: int) -> None:
        configure(given.filter(F.col("v") == batch_id).drop("v"), batch_id)   # the config stream's batch that comes before
        sync(batch, batch_id)

    run_batches(t, cdc.parse(Inputs.change_log(t.even_batches("orders", "o_orderkey").drop("place"))), step, "live")
    cells = [F.try_element_at(F.col("info"), F.lit(c)) for c in ("id", "order_id", "order_status", "payment_type", "province_id", "refund_num")]
    return dimsync.live_rows(store, table).withColumn("info", F.concat_ws("|", *cells))


@query("cdc_clean_images", """SELECT op, ("table" = 'x')::BIGINT has_before, count(*) n FROM (SELECT 'u' op, 'order_info' AS "table" FROM heads UNION ALL SELECT 'c', 'order_detail' FROM c_line UNION ALL
    SELECT 'c', 'a' FROM heads WHERE o_orderkey%2=0 UNION ALL SELECT 'c', 'b' FROM heads WHERE o_orderkey%3=1 UNION ALL SELECT 'u', 'p' FROM heads WHERE o_orderstatus='F' UNION ALL
    SELECT 'u', 'r' FROM heads WHERE o_orderstatus='O' UNION ALL SELECT 'u', 's' FROM heads WHERE o_orderstatus='O' AND o_orderkey%2=0) GROUP BY ALL""")
def _(t):
    images = cdc.cleaned(cdc.parse(Inputs.change_log(t.raw("orders"))))
    return images.groupBy("op", F.col("before").isNotNull().alias("has_before")).agg(F.count(F.lit(1)).alias("n"))


# ---- topic load ----------------------------------------------------------------------------

@query("stream_position_load", """SELECT 'V'||user_id vehicleno, event_id id, (user_id%180)::DOUBLE lon, (k%90)::DOUBLE lat, strftime(ts,'%Y-%m-%d') ds, epoch_us(ts)//1000 ts FROM ev""")
def _(t):
    message = F.to_json(F.struct(
        F.col("event_id").alias("id"), F.concat(F.lit("V"), "user_id").alias("vehicleno"),
        (F.col("user_id") % 180).cast("double").alias("lon"), (F.col("k") % 90).cast("double").alias("lat"),
        F.date_format("ts", "yyyy-MM-dd").alias("ds"), F.unix_millis("ts").alias("ts")))
    rows = kafka.as_records(events(t).select(message.alias("value")), schemas.VEHICLE_POSITION)
    return run(t, rows.select("id", "vehicleno", "lon", "lat", "ts", "ds"), "positions", partition_by="ds")


# ---- labels --------------------------------------------------------------------------------

@query("stream_label_order_scores", """SELECT detail_id, uid, pay_time_slot, spending_pow, tname_18_24::DOUBLE tname_18_24, b1name_50::DOUBLE b1name_50 FROM l_order""")
def _(t):
    """Order-line scores on a stream of lines joined with the order table."""
    lines = Inputs.shape_lines(t.raw_stream("lineitem")).select(
        "detail_id", F.col("l_orderkey").alias("_o"), F.col("l_partkey").alias("sku_id"))
    key = F.col("o_orderkey")
    heads = t.heads.select(key.alias("order_id"), (F.col("o_custkey") % 150).cast("string").alias("uid"),
                           (F.unix_millis("ordered") + key % 24 * 3_600_000).alias("create_time"),
                           (key % 5000).cast("decimal(16,2)").alias("total_amount"))
    joined = lines.join(heads, F.col("_o") == F.col("order_id"))
    scored = persona.order_scores(joined, t.label_skus, t.label_categories)
    return run(t, scored.select("detail_id", "uid", "pay_time_slot", "spending_pow", "tname_18_24", "b1name_50"), "label_orders")


@query("stream_label_user_base", """SELECT u.uid, age, decade, zodiac_sign, gender, m.height FROM l_user u JOIN l_body m ON m.uid=u.uid""")
def _(t):
    """Profile rows joined with body metrics that arrive within five minutes."""
    users = Inputs.shape_users(t.raw_stream("customer"))
    base = persona.profile_labels(users, log_day()).withColumn("ms", F.col("uid").cast("bigint") * 1000 + 1_700_000_000_000)
    body = t.raw_stream("customer").select(
        F.col("c_custkey").cast("string").alias("body_uid"), (F.col("c_custkey") % 50 + 150).cast("string").alias("height"),
        (F.col("c_custkey") * 1000 + 1_700_000_060_000).alias("body_ms"))
    left, right = timed(base, "ms", "base_et"), timed(body, "body_ms", "body_et")
    out = joins.interval_join(left, right, [("uid", "body_uid")], "base_et", "body_et", "5 MINUTES", "5 MINUTES")
    return run(t, out.select("uid", "age", "decade", "zodiac_sign", "gender", "height"), "label_base")
