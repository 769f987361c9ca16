"""Column functions, cleaning rules, table maintenance and quality checks over whole tables."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import functions as F, types as T

from ..bridge.sql import half_up, num
from ..bridge.tables import LOG_DAY
from ..functions import cleaning, keys, persona, ratios, timekeys
from ..operators import joins, latest, lists, observed, quality, ranking, recent, sets, shares
from ..plans import day_job, retail_daily, retail_facts
from ..session import cut_lineage, scratch_path
from ..sources import bucketed, files, switched, tables, ziptables
from .base import query
from .retail import L_DAY, T_DAY, _day, log_day, trade_day

# ---- functions -----------------------------------------------------------------------------


@query("fn_json_paths", """SELECT CASE WHEN NOT broken THEN ch END channel, CASE WHEN NOT broken THEN uid END uid, CASE WHEN NOT broken AND NOT is_start THEN page_id END page_id,
    strftime(dt,'%Y-%m-%d') dt FROM log_all""")
def _(t):
    paths = {"channel": "$.common.ch", "uid": "$.common.uid", "page_id": "$.page.page_id"}
    return t.raw_log.select(*keys.json_paths(F.col("log"), paths), "dt")


@query("fn_time_text", f"""SELECT event_id, strftime(ts,'%Y-%m-%d %H:%M:%S') from_millis, strftime(ts,'%Y%m%d') compact_day, strftime(ts,'%Y-%m-%d') day_text,
    strftime(ts,'%Y-%m-%d %H:%M:%S') from_iso, strftime(ts,'%Y-%m-%d') back_from_compact, strftime(ts + INTERVAL 8 HOUR,'%Y-%m-%d %H:%M:%S') local_time FROM ev""")
def _(t):
    ms = F.unix_millis("ts")
    iso = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit(".000Z"))
    return t.events.select(
        "event_id", timekeys.millis_text(ms).alias("from_millis"), timekeys.compact_day(F.col("ts")).alias("compact_day"),
        timekeys.millis_text(ms.cast("string"), timekeys.DAY).alias("day_text"), timekeys.iso_text(iso).alias("from_iso"),
        timekeys.day_from_compact(timekeys.compact_day(F.col("ts"))).alias("back_from_compact"),
        timekeys.local_time(ms, "Asia/Shanghai").alias("local_time"))


@query("fn_calendar", f"""SELECT o_orderkey, {_day('ordered + INTERVAL 7 DAY', 'plus_week')}, ({T_DAY}-ordered::DATE)::BIGINT age_days, {_day("date_trunc('week', ordered)", 'week_monday')},
    strftime(ordered,'%Y-%m') month_key, strftime(ordered + INTERVAL 2 DAY,'%Y%m%d') third_day,
    ({T_DAY}-ordered::DATE >= 0 AND {T_DAY}-ordered::DATE < 30)::BIGINT in_30_days FROM heads""")
def _(t):
    day = F.to_date("ordered")
    return t.heads.select(
        "o_orderkey", F.date_add(day, 7).alias("plus_week"), F.datediff(trade_day(), day).alias("age_days"),
        timekeys.week_start(day).alias("week_monday"), timekeys.month_key(day).alias("month_key"),
        timekeys.day_range(day, F.date_add(day, 2))[2].alias("third_day"),
        timekeys.within_recent(day, trade_day(), 30).alias("in_30_days"))


@query("fn_birthdays", f"""SELECT uid, strftime(b,'%Y-%m-%d') birthday, age, decade, zodiac_sign FROM l_user""")
def _(t):
    born = timekeys.date_from_epoch_day(F.col("birthday"))
    return t.user_info.select(F.col("id").cast("string").alias("uid"), born.alias("birthday"),
                              persona.full_years(born, log_day()).alias("age"), persona.decade(born).alias("decade"),
                              persona.zodiac(born).alias("zodiac_sign"))


@query("fn_day_slot", """SELECT event_id, CASE WHEN hour(ts)<6 THEN '凌晨' WHEN hour(ts)<9 THEN '早晨' WHEN hour(ts)<12 THEN '上午' WHEN hour(ts)<14 THEN '中午'
    WHEN hour(ts)<18 THEN '下午' WHEN hour(ts)<22 THEN '晚上' ELSE '夜间' END slot FROM ev""")
def _(t):
    return t.events.select("event_id", timekeys.day_slot(F.col("ts")).alias("slot"))


_HEX = "(instr('0123456789abcdef', substr(md5({0}),{1},1))-1)"
_TAIL = "+".join(f"{_HEX.format('c_name', 30 + i)}*{16 ** (2 - i)}" for i in range(3))


@query("fn_shard", f"SELECT c_custkey, lpad((({_TAIL})%128)::VARCHAR,4,'0') shard, lpad((({_TAIL})%128)::VARCHAR,4,'0') shard_reserved, md5(c_name) row_key FROM customer")
def _(t):
    name = F.col("c_name")
    return t.raw("customer").select("c_custkey", keys.shard(name).alias("shard"),
                                    keys.shard_with_reserved(name).alias("shard_reserved"), keys.row_key(name).alias("row_key"))


@query("fn_text", """SELECT doc_id, md5(string_split(text, ' ')[1]) first_word, md5(string_split(text, ',')[-1]) last_item, md5(lower(text)) lowered,
    length(replace(text, ',', ''))::BIGINT without_commas, lang||':'||source tag, substr(text,1,1)||'*' masked FROM documents""")
def _(t):
    text = F.col("text")
    return t.raw("documents").select(
        "doc_id", F.md5(keys.first_word(text)).alias("first_word"), F.md5(keys.last_item(text)).alias("last_item"),
        F.md5(F.lower(text)).alias("lowered"), F.length(F.replace(text, F.lit(","), F.lit(""))).alias("without_commas"),
        F.concat_ws(":", "lang", "source").alias("tag"), cleaning.masked_name(text).alias("masked"))


@query("fn_decimals", f"""SELECT detail_id, {num('(qty*price)::DECIMAL(16,2)')} amount, {num('round(price*0.1::DECIMAL(4,2), 2)')} tenth,
    {half_up('(price*100)::HUGEINT', '100*qty', 3)} unit_price, coalesce(disc, 0) disc, CASE WHEN disc=0 THEN NULL ELSE disc END disc_or_null FROM lines""")
def _(t):
    return t.lines.select(
        "detail_id", (F.col("qty") * F.col("price")).cast("decimal(16,2)").alias("amount"),
        ratios.half_up(F.col("price") * F.lit("0.1").cast("decimal(4,2)"), 2).alias("tenth"),
        ratios.share(F.col("price"), F.col("qty"), 3).alias("unit_price"), F.coalesce("disc", F.lit(0)).alias("disc"),
        F.nullif("disc", F.lit(0)).alias("disc_or_null"))


@query("fn_arrays", """SELECT user_id, string_agg(DISTINCT event_type, '->' ORDER BY event_type) kinds, min(event_type) first_kind, max(event_type) last_kind,
    count(DISTINCT event_type) n FROM ev GROUP BY user_id""")
def _(t):
    # Event types are a handful, so their list is bounded.
    kinds = t.events.groupBy("user_id").agg(F.array_sort(F.collect_set("event_type")).alias("kinds"))
    arr = F.col("kinds")
    return kinds.select("user_id", F.array_join(arr, "->").alias("kinds"), F.element_at(arr, 1).alias("first_kind"),
                        F.element_at(arr, -1).alias("last_kind"), F.size(arr).alias("n"))


# ---- cleaning ------------------------------------------------------------------------------

@query("clean_live_snapshot", "SELECT id, order_no, status FROM waybill WHERE is_deleted='0'")
def _(t):
    return t.waybill.filter(cleaning.not_deleted()).select("id", "order_no", "status")


@query("clean_status_filter", "SELECT id, status FROM waybill WHERE status NOT IN ('60010','60999')")
def _(t):
    return t.waybill.filter(cleaning.status_not_in(F.col("status"), ["60010", "60999"])).select("id", "status")


@query("clean_required_fields", "SELECT page_id, visitor_id, is_order::BIGINT is_order FROM entry_log WHERE visitor_id IS NOT NULL AND is_order IN (0,1)")
def _(t):
    return t.entry_log.filter(cleaning.required("page_id", "visitor_id") & F.col("is_order").isin(0, 1)) \
        .select("page_id", "visitor_id", "is_order")


@query("clean_natural_key", f"""SELECT l_orderkey, l_linenumber, detail_id FROM lines QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY ship DESC, detail_id)=1""")
def _(t):
    rows = t.lines.select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), "ship", "detail_id")
    return latest.dedup_natural_key(rows, ["l_orderkey", "l_linenumber"], [F.col("ship").desc(), F.col("detail_id")]).drop("ship")


@query("clean_terminal_split", "SELECT lower(terminal_type) terminal, count(*) n FROM entry_log GROUP BY 1")
def _(t):
    parts = [t.entry_log.filter(cleaning.terminal_is(F.col("terminal_type"), name)).agg(F.count(F.lit(1)).alias("n"))
             .select(F.lit(name).alias("terminal"), "n") for name in ("pc", "wireless")]
    return sets.union_all(*parts)


@query("clean_personal_data", rf"""SELECT id, md5(name) name, CASE WHEN regexp_matches(phone_num, '^(13[0-9]|14[01456879]|15[0-35-9]|16[2567]|17[0-8]|18[0-9]|19[0-35-9])\d{{8}}$') THEN md5(phone_num) END phone,
    CASE WHEN regexp_matches(email, '^[a-zA-Z0-9_-]+@[a-zA-Z0-9_-]+(\.[a-zA-Z0-9_-]+)+$') THEN md5(email) END email, sha256('pepper'||name) salted, substr(name,1,1)||'*' masked FROM user_info""")
def _(t):
    name = F.col("name")
    return t.user_info.select(
        "id", cleaning.hashed(name).alias("name"), cleaning.hashed_phone(F.col("phone_num")).alias("phone"),
        cleaning.hashed_email(F.col("email")).alias("email"), cleaning.hashed(name, "pepper").alias("salted"),
        cleaning.masked_name(name).alias("masked"))


# ---- joins, sets, windows --------------------------------------------------------------------

@query("join_same_dictionary_roles", """SELECT w.id, a.name status_name, b.name collect_type_name, c.name payment_type_name FROM waybill w
    LEFT JOIN freight_dictionary a ON a.id::VARCHAR=w.status LEFT JOIN freight_dictionary b ON b.id::VARCHAR=w.collect_type
    LEFT JOIN freight_dictionary c ON c.id::VARCHAR=w.payment_type""")
def _(t):
    roles = {"status": "status_name", "collect_type": "collect_type_name", "payment_type": "payment_type_name"}
    return joins.attach_roles(t.waybill.select("id", *roles), t.freight_dictionary, "id", "name", roles).drop(*roles)


@query("join_parent_organisation", "SELECT o.id, o.org_name, p.org_name parent_name FROM organ o LEFT JOIN organ p ON p.id=o.org_parent_id")
def _(t):
    return joins.attach_parent(t.organ.select("id", "org_name", "org_parent_id"), "id", "org_parent_id",
                               {"parent_name": "org_name"}).drop("org_parent_id")


@query("join_region_climb", """SELECT o.id, a.name l1_name, b.name l2_name, c.name l3_name FROM organ o LEFT JOIN freight_region a ON a.id=o.region_id
    LEFT JOIN freight_region b ON b.id=a.parent_id LEFT JOIN freight_region c ON c.id=b.parent_id""")
def _(t):
    return joins.climb(t.organ.select("id", "region_id"), t.freight_region, "region_id", ["l1", "l2", "l3"]) \
        .drop("region_id", "l1_id", "l2_id", "l3_id")


@query("join_lookup_or_missing", "SELECT event_id, coalesce(p.pos_location,'N/A') place FROM ev LEFT JOIN promotion_pos p ON p.id=ev.k")
def _(t):
    return joins.attach_lookup(t.events.select("event_id", "k"), t.promotion_pos, "k", "id", "pos_location", "place").drop("k")


@query("join_merge_metrics", """SELECT coalesce(a.user_id, b.user_id) user_id, carts, favors FROM (SELECT user_id, count(*) carts FROM cart_info GROUP BY 1) a
    FULL JOIN (SELECT user_id, count(*) favors FROM favor_info WHERE is_cancel='0' GROUP BY 1) b ON a.user_id=b.user_id""")
def _(t):
    carts = t.cart_info.groupBy("user_id").agg(F.count(F.lit(1)).alias("carts"))
    favors = t.favor_info.filter(F.col("is_cancel") == "0").groupBy("user_id").agg(F.count(F.lit(1)).alias("favors"))
    return joins.merge_metrics(["user_id"], carts, favors)


@query("join_scalar_metrics", "SELECT count(*) n, count(DISTINCT user_id) users, count(*) FILTER (event_type='purchase') orders, sum(val)::DOUBLE total FROM ev")
def _(t):
    return shares.scalar_row(t.events, {
        "n": F.count(F.lit(1)), "users": F.count_distinct("user_id"),
        "orders": F.count(F.when(F.col("event_type") == "purchase", 1)), "total": F.sum("val")})


@query("join_share_of_group", f"SELECT event_type, k, n, {half_up('n', 'sum(n) OVER (PARTITION BY event_type)', 4)} share FROM (SELECT event_type, k, count(*) n FROM ev GROUP BY 1,2)")
def _(t):
    pairs = t.events.groupBy("event_type", "k").agg(F.count(F.lit(1)).alias("n"))
    return joins.share_of_group(pairs, ["event_type"], "n", "share")


@query("share_of_total", f"SELECT c_mktsegment, n, {half_up('100*n', 'sum(n) OVER ()', 2)} pct FROM (SELECT c_mktsegment, count(*) n FROM customer GROUP BY 1)")
def _(t):
    counts = t.raw("customer").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    return shares.with_total_share(counts, "n", "pct")


@query("union_all_and_distinct", """SELECT 'all' kind, count(*) n FROM (SELECT user_id, k FROM ev WHERE event_type='view' UNION ALL SELECT user_id, k FROM ev WHERE event_type='click') UNION ALL
    SELECT 'distinct', count(*) FROM (SELECT user_id, k FROM ev WHERE event_type='view' UNION SELECT user_id, k FROM ev WHERE event_type='click')""")
def _(t):
    side = lambda kind: t.events.filter(F.col("event_type") == kind).select("user_id", "k")
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("kind"), "n")
    a, b = side("view"), side("click")
    return sets.union_all(count(sets.union_all(a, b), "all"), count(sets.union_distinct(a, b), "distinct"))


@query("rank_all_customers", "SELECT c_custkey, rank() OVER (ORDER BY c_acctbal::DECIMAL(16,2) DESC) balance_rank FROM customer")
def _(t):
    rows = t.raw("customer").select("c_custkey", F.col("c_acctbal").cast("decimal(16,2)").alias("bal"))
    return ranking.ranked(rows, "bal", ["c_custkey"], "balance_rank").drop("bal")


@query("number_lines_per_day", f"SELECT detail_id, {_day('ship', 'dt')}, row_number() OVER (PARTITION BY ship ORDER BY price DESC, detail_id) n FROM lines")
def _(t):
    rows = t.lines.select("detail_id", F.to_date("ship").alias("dt"), "price")
    return ranking.numbered_per_group(rows, ["dt"], [F.col("price").desc(), F.col("detail_id")], "n").drop("price")


@query("ordered_report", "SELECT p_brand, sum(p_retailprice::DECIMAL(16,2))::DOUBLE total FROM part GROUP BY 1 ORDER BY total DESC, p_brand")
def _(t):
    out = t.raw("part").groupBy("p_brand").agg(F.sum(F.col("p_retailprice").cast("decimal(16,2)")).alias("total"))
    return out.orderBy(F.col("total").desc(), "p_brand")


@query("recent_visitors_by_channel", f"""SELECT k%5 channel, count(DISTINCT user_id) FILTER (ts::DATE > {L_DAY}-1) users_1d, count(DISTINCT user_id) FILTER (ts::DATE > {L_DAY}-7) users_7d,
    count(DISTINCT user_id) users_30d FROM ev WHERE ts::DATE <= {L_DAY} AND ts::DATE > {L_DAY}-30 GROUP BY 1""")
def _(t):
    rows = t.events.select((F.col("k") % 5).alias("channel"), "user_id", F.to_date("ts").alias("dt"))
    return recent.last_seen_counts(rows, ["channel"], "user_id", "dt", log_day(), [1, 7, 30], "users")


@query("list_couriers", "SELECT DISTINCT complex_id, courier_emp_id::VARCHAR courier FROM courier_complex WHERE courier_emp_id IS NOT NULL")
def _(t):
    return lists.members(t.courier_complex, ["complex_id"], F.col("courier_emp_id").cast("string"), "courier")


# ---- quality -------------------------------------------------------------------------------

@query("quality_profile", """SELECT count(*) row_count, count(qty) qty_count, min(qty)::DOUBLE qty_min, sum(qty)::DOUBLE/count(qty) qty_avg, max(qty)::DOUBLE qty_max,
    count(price) price_count, min(price)::DOUBLE price_min, sum(price)::DOUBLE/count(price) price_avg, max(price)::DOUBLE price_max,
    count(DISTINCT (l_partkey, l_suppkey)) pair_count FROM lines""")
def _(t):
    return quality.profile(t.lines, ["qty", "price"], ["l_partkey", "l_suppkey"])


@query("quality_distribution", "SELECT 'event_type' column_name, event_type AS value, count(*) row_count FROM ev GROUP BY event_type")
def _(t):
    return quality.distribution(t.events, "event_type")


@query("quality_layer_counts", """SELECT 'events' layer, count(*) row_count FROM ev UNION ALL SELECT 'page_views', count(*) FROM page_view UNION ALL
    SELECT 'sessions', count(*) FROM session_1d""")
def _(t):
    views = retail_facts.page_view_fact(quality.require_rows(t.raw_log, "raw log"))
    return quality.row_counts({"events": t.events, "page_views": views, "sessions": retail_daily.session_daily(views)})


@query("quality_reconcile", f"""SELECT {_day('dt')}, count(*) lower_rows, (SELECT count(*) FROM session_1d s WHERE s.dt=p.dt) upper_rows,
    (count(*) = (SELECT count(*) FROM session_1d s WHERE s.dt=p.dt))::BIGINT is_equal FROM page_view p GROUP BY dt""")
def _(t):
    views = retail_facts.page_view_fact(t.raw_log)
    return quality.reconcile(views, retail_daily.session_daily(views), ["dt"])


@query("quality_observed_layers", """SELECT 'events' layer, 'row_count' measure, count(*)::DOUBLE AS value FROM ev
    UNION ALL SELECT 'events', 'user_id_nulls', count(*) FILTER (user_id IS NULL) FROM ev
    UNION ALL SELECT 'events', 'user_id_min', min(user_id) FROM ev UNION ALL SELECT 'events', 'user_id_max', max(user_id) FROM ev
    UNION ALL SELECT 'page_views', 'row_count', count(*) FROM page_view UNION ALL SELECT 'sessions', 'row_count', count(*) FROM session_1d""")
def _(t):
    """Three layers are written, each gated by the figures of the one below; every figure comes from a writing job."""
    root = scratch_path(t.spark, "layers")
    figures = {"events": observed.write_measured(t.events.withColumn("dt", F.to_date("ts")), f"{root}/events", measures={
        **observed.nulls("user_id"), **observed.bounds("user_id")})}
    observed.require_written(figures["events"], "events")
    figures["page_views"] = observed.write_measured(retail_facts.page_view_fact(t.raw_log), f"{root}/page_views")
    observed.require_written(figures["page_views"], "page views")
    views = t.spark.read.parquet(f"{root}/page_views")
    figures["sessions"] = observed.write_measured(retail_daily.session_daily(views), f"{root}/sessions")
    return observed.as_rows(t.spark, figures)


# ---- files and tables ------------------------------------------------------------------------

@query("table_tsv_round_trip", f"SELECT event_id, user_id, event_type, strftime(ts,'%Y%m%d') dt FROM ev")
def _(t):
    path = scratch_path(t.spark, "tsv")
    rows = t.events.select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), "user_id", "event_type")
    rows.write.csv(path, sep="\t", header=True)
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampType()),
                           T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType())])
    return files.with_partition(files.read_tsv(t.spark, path, schema), "ts").drop("ts")


@query("table_orc_round_trip", f"SELECT detail_id, qty, price::DOUBLE price, l_returnflag FROM lines")
def _(t):
    path = scratch_path(t.spark, "orc")
    rows = t.lines.select("detail_id", "qty", "price", "l_returnflag")
    files.write_columnar(rows, path, "orc", ["l_returnflag"])
    schema = T.StructType([*rows.schema.fields])
    return t.spark.read.schema(schema).orc(path)


@query("table_overwrite_days", f"""SELECT {_day('ts::DATE', 'dt')}, user_id, count(*) n, CASE WHEN ts::DATE={L_DAY} THEN 1 ELSE 0 END::BIGINT rewritten FROM ev GROUP BY ts::DATE, user_id""")
def _(t):
    """A month of days is written, then the last day is written again."""
    path = scratch_path(t.spark, "days")
    daily = t.events.groupBy(F.to_date("ts").alias("dt"), "user_id").agg(F.count(F.lit(1)).alias("n"))
    tables.overwrite_days(daily.withColumn("rewritten", F.lit(0)), path)
    for _ in range(2):
        tables.overwrite_days(daily.filter(F.col("dt") == log_day()).withColumn("rewritten", F.lit(1)), path)
    return t.spark.read.parquet(path).select("dt", "user_id", "n", "rewritten")


_LAST_THREE = [f"2024-01-{d}" for d in (28, 29, 30)]


@query("day_job_carts", f"""SELECT user_id, {_day('create_time::DATE', 'dt')}, count(*) cart_add_count_1d, sum(sku_num)::BIGINT cart_add_num_1d FROM cart_info
    WHERE create_time::DATE BETWEEN {L_DAY}-2 AND {L_DAY} GROUP BY user_id, create_time::DATE""")
def _(t):
    """Source, fact and daily summary of three days, built day by day; the last day runs twice."""
    root = scratch_path(t.spark, "carts")
    tables.overwrite_days(t.cart_info.withColumn("dt", F.to_date("create_time")), f"{root}/ods")
    layers = [day_job.Layer("fact", f"{root}/ods", f"{root}/dwd", lambda rows: retail_facts.cart_add_fact(rows.drop("dt"))),
              day_job.Layer("summary", f"{root}/dwd", f"{root}/dws", lambda rows: retail_daily.user_cart_daily(rows))]
    for day in [*_LAST_THREE, _LAST_THREE[-1]]:
        day_job.run_day(t.spark, layers, day)
    return day_job.recent_days(t.spark, f"{root}/dws", LOG_DAY, 30).select("user_id", "dt", "cart_add_count_1d", "cart_add_num_1d")


@query("day_job_waybills", f"""SELECT strftime(date_trunc('year', ordered)::DATE,'%Y-%m-%d') dt, status, count(*) n, sum(amount)::DOUBLE amount FROM waybill JOIN heads ON o_orderkey=id
    WHERE is_deleted='0' GROUP BY 1, 2""")
def _(t):
    """The same for waybills, with one partition a year; rows deleted in the snapshot are left out by the job."""
    root = scratch_path(t.spark, "waybills")
    rows = t.waybill.join(t.heads.select(F.col("o_orderkey").alias("id"), F.to_date(F.trunc("ordered", "year")).alias("dt")), "id")
    tables.overwrite_days(rows, f"{root}/ods")
    layers = [day_job.Layer("fact", f"{root}/ods", f"{root}/dwd", lambda day: day.select("id", "status", "amount")),
              day_job.Layer("summary", f"{root}/dwd", f"{root}/dws", lambda day: day.groupBy("status").agg(
                  F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount")))]
    days = tables.list_partitions(t.spark, f"{root}/ods")
    for day in [*days, days[-1]]:
        day_job.run_day(t.spark, layers, day)
    return t.spark.read.parquet(f"{root}/dws").select("dt", "status", "n", F.col("amount").cast("double").alias("amount"))


@query("table_accumulate_report", f"""SELECT {_day('d', 'dt')}, event_type, n FROM (SELECT ts::DATE d, event_type, count(*) n FROM ev GROUP BY 1,2) WHERE d >= {L_DAY}-2""")
def _(t):
    """Three report days arrive one after the other, the last one twice."""
    path = scratch_path(t.spark, "report")
    daily = t.events.groupBy(F.to_date("ts").alias("dt"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    for back in (2, 1, 0, 0):
        tables.accumulate_report(daily.filter(F.col("dt") == F.date_sub(log_day(), back)), path)
    return t.spark.read.parquet(path).select("dt", "event_type", "n")


@query("table_retention", f"SELECT {_day('ts::DATE', 'dt')}, count(*) n FROM ev WHERE ts::DATE >= {L_DAY}-10 GROUP BY ts::DATE")
def _(t):
    path = scratch_path(t.spark, "retention")
    tables.overwrite_days(t.events.withColumn("dt", F.to_date("ts")), path)
    tables.retain_days(t.spark, path, date.fromisoformat(LOG_DAY), keep_past=10)
    return t.spark.read.parquet(path).groupBy("dt").agg(F.count(F.lit(1)).alias("n"))


@query("table_distributed_write", f"SELECT 'V'||user_id vehicleno, {_day('ts::DATE', 'ds')}, count(*) n FROM ev GROUP BY user_id, ts::DATE")
def _(t):
    path = scratch_path(t.spark, "positions")
    rows = t.events.select(F.concat(F.lit("V"), "user_id").alias("vehicleno"), F.to_date("ts").alias("ds"))
    tables.write_distributed(rows, path, "ds", "vehicleno")
    return t.spark.read.parquet(path).groupBy("vehicleno", "ds").agg(F.count(F.lit(1)).alias("n"))


@query("table_report_switch", f"""SELECT {_day('ts::DATE', 'dt')}, user_id, count(*) n, CASE WHEN ts::DATE={L_DAY} THEN 1 ELSE 0 END::BIGINT rewritten FROM ev GROUP BY ts::DATE, user_id""")
def _(t):
    """A report of all days, then its last day reported again, twice; a reader sees each load whole."""
    daily = t.events.groupBy(F.to_date("ts").alias("dt"), "user_id").agg(F.count(F.lit(1)).alias("n"), F.lit(0).alias("rewritten"))
    report = switched.SwitchedTable(t.spark, scratch_path(t.spark, "report"), daily.schema)
    report.replace(daily)
    for _ in range(2):
        report.replace(daily.filter(F.col("dt") == log_day()).withColumn("rewritten", F.lit(1)), [LOG_DAY])
    report.vacuum(keep=1)
    return report.read()


@query("table_zip_by_end_date", """WITH y AS (SELECT o_custkey, year(ordered) yr, o_orderpriority lvl FROM heads
        QUALIFY row_number() OVER (PARTITION BY o_custkey, year(ordered) ORDER BY ordered DESC, o_orderkey DESC)=1),
    s AS (SELECT o_custkey, lvl, make_date(yr,12,31) d FROM (SELECT *, lag(lvl) OVER (PARTITION BY o_custkey ORDER BY yr) was FROM y) WHERE was IS DISTINCT FROM lvl)
    SELECT o_custkey user_id, lvl user_level, strftime(d,'%Y-%m-%d') start_date,
        strftime(coalesce(lead(d) OVER (PARTITION BY o_custkey ORDER BY d) - 1, DATE '9999-12-31'),'%Y-%m-%d') end_date FROM s""")
def _(t):
    """Customer levels, loaded at the end of each year from the customers who ordered in it; the last load runs twice."""
    last = cut_lineage(t.heads.groupBy(F.col("o_custkey").alias("user_id"), F.year("ordered").alias("yr")).agg(
        F.max_by("o_orderpriority", F.struct("ordered", "o_orderkey")).alias("user_level")))
    years = [row.yr for row in last.select("yr").distinct().orderBy("yr").collect()]
    levels = last.select("user_id", "user_level")
    history = ziptables.ZipTable(t.spark, scratch_path(t.spark, "levels"), levels.schema, ["user_id"])
    for year in [*years, *years[-1:]]:
        history.load(last.filter(F.col("yr") == year).select("user_id", "user_level"), date(year, 12, 31))
    return history.read()


@query("table_bucketed_join", "SELECT o_orderkey, o_orderpriority, count(*) n, sum(qty)::BIGINT qty FROM heads JOIN lines ON l_orderkey=o_orderkey GROUP BY ALL")
def _(t):
    """Orders and their lines stored in the same buckets; the join and the sum need no shuffle."""
    lines, tag = t.lines.select("l_orderkey", "qty"), uuid.uuid4().hex
    buckets = bucketed.buckets_for(lines, least=4)
    stored = bucketed.write_bucketed(lines, f"lines_{tag}", ["l_orderkey"], buckets, scratch_path(t.spark, "lines"))
    heads = bucketed.write_bucketed(t.heads.select("o_orderkey", "o_orderpriority"), f"heads_{tag}", ["o_orderkey"], buckets,
                                    scratch_path(t.spark, "heads"))
    return stored.join(heads, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_orderkey", "o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), F.sum("qty").alias("qty"))


@query("table_recovered_days", f"SELECT {_day('ts::DATE', 'dt')}, event_type, count(*) n FROM ev GROUP BY ts::DATE, event_type")
def _(t):
    """Days written straight to the files of a catalog table, then made visible in it."""
    table, path = f"events_{uuid.uuid4().hex}", scratch_path(t.spark, "events")
    rows = t.events.select("event_id", "event_type", F.to_date("ts").alias("dt"))
    tables.create_day_table(t.spark, table, path, rows)
    tables.overwrite_days(rows, path)
    tables.recover_partitions(t.spark, table)
    return t.spark.table(table).groupBy("dt", "event_type").agg(F.count(F.lit(1)).alias("n"))
