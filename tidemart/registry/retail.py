"""Retail dimensions, facts, summaries and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..bridge.sql import CTES, big, cents, half_up, num
from ..bridge.tables import Inputs, LOG_DAY, TRADE_DAY
from ..operators import history
from ..plans import retail_daily as daily, retail_dims as dims, retail_facts as facts, retail_reports as reports
from .base import query

T_DAY, L_DAY = f"DATE '{TRADE_DAY}'", f"DATE '{LOG_DAY}'"


def trade_day():
    return F.lit(TRADE_DAY).cast("date")


def log_day():
    return F.lit(LOG_DAY).cast("date")


def sku(t: Inputs) -> DataFrame:
    return dims.sku_core(t.sku_info, t.spu_info, dims.category_levels(t.category3, t.category2, t.category1), t.trademark)


def lines(t: Inputs) -> DataFrame:
    return facts.order_line_core(t.order_detail, t.order_head, ["user_id"])


def province_lines(t: Inputs) -> DataFrame:
    return facts.order_line_core(t.order_detail, t.order_info, ["province_id"])


def order_detail(t: Inputs) -> DataFrame:
    return facts.order_detail_fact(t.order_detail, t.order_info, t.order_detail_activity, t.order_detail_coupon)


def views(t: Inputs) -> DataFrame:
    return facts.page_view_fact(t.raw_log)


def logins(t: Inputs) -> DataFrame:
    return facts.login_fact(views(t)).withColumn("dt", F.col("date_id"))


CTES.update({
    "dim_sku": """SELECT s.*, u.spu_name, c1.id category1_id, c1.name category1_name, c2.id category2_id, c2.name category2_name,
        c3.id category3_id, c3.name category3_name, tm.tm_name FROM sku_info s LEFT JOIN spu_info u ON s.spu_id=u.id
        LEFT JOIN category3 c3 ON u.category3_id=c3.id LEFT JOIN category2 c2 ON c3.category2_id=c2.id
        LEFT JOIN category1 c1 ON c2.category1_id=c1.id LEFT JOIN trademark tm ON tm.id=s.tm_id""",
    "dim_coupon": """SELECT c.*, a.dic_name coupon_type_name, b.dic_name range_type_name, CASE coupon_type
        WHEN '3201' THEN '满'||condition_amount||'元减'||benefit_amount||'元' WHEN '3202' THEN '满'||condition_num||'件打'||benefit_discount||' 折'
        WHEN '3203' THEN '减'||benefit_amount||'元' END benefit_rule FROM coupon_info c
        LEFT JOIN dictionary a ON a.parent_code='32' AND a.dic_code=coupon_type
        LEFT JOIN dictionary b ON b.parent_code='33' AND b.dic_code=range_type""",
    "dim_province": "SELECT p.*, p.name province_name, a.region_name FROM province p LEFT JOIN area a ON a.id=p.region_id",
    "dwd_line": """SELECT d.id, d.order_id, d.sku_id, d.create_time, d.sku_num, (d.sku_num*d.order_price)::DECIMAL(16,2) split_original_amount,
        coalesce(d.split_activity_amount,0)::DECIMAL(16,2) split_activity_amount, coalesce(d.split_coupon_amount,0)::DECIMAL(16,2) split_coupon_amount,
        d.split_total_amount, d.create_time::DATE dt, o.user_id FROM order_detail d LEFT JOIN order_head o ON d.order_id=o.id""",
    "dwd_order_detail": """SELECT l.*, o.province_id, a.activity_id, a.activity_rule_id, c.coupon_id FROM dwd_line l
        LEFT JOIN order_info o ON l.order_id=o.id LEFT JOIN order_detail_activity a ON a.order_detail_id=l.id
        LEFT JOIN order_detail_coupon c ON c.order_detail_id=l.id""",
    "dws_user_sku": """SELECT user_id, sku_id, dt, count(id) order_count_1d, sum(sku_num) order_num_1d,
        sum(split_original_amount) order_original_amount_1d, sum(split_activity_amount) activity_reduce_amount_1d,
        sum(split_coupon_amount) coupon_reduce_amount_1d, sum(split_total_amount) order_total_amount_1d FROM dwd_line GROUP BY ALL""",
    "dws_province": """SELECT province_id, dt, count(DISTINCT order_id) order_count_1d, sum(split_original_amount) order_original_amount_1d,
        sum(split_activity_amount) activity_reduce_amount_1d, sum(split_coupon_amount) coupon_reduce_amount_1d,
        sum(split_total_amount) order_total_amount_1d FROM (SELECT l.*, o.province_id FROM dwd_line l LEFT JOIN order_info o ON l.order_id=o.id) GROUP BY ALL""",
    "dwd_pay": """SELECT d.id, p.order_id, p.user_id, d.sku_id, d.province_id, d.activity_id, d.activity_rule_id, d.coupon_id,
        p.payment_type payment_type_code, x.dic_name payment_type_name, p.callback_time::DATE date_id, p.callback_time, d.sku_num,
        (split_activity_amount+split_coupon_amount+split_total_amount)::DECIMAL(16,2) split_original_amount, split_activity_amount, split_coupon_amount,
        split_total_amount split_payment_amount FROM dwd_order_detail d
        LEFT JOIN payment_info p ON p.order_id=d.order_id AND p.payment_status='1602'
        LEFT JOIN dictionary x ON x.parent_code='11' AND x.dic_code=p.payment_type""",
    "trade_flow": """SELECT o.id order_id, o.user_id, o.province_id, o.create_time::DATE order_date_id, o.create_time order_time,
        p.callback_time::DATE payment_date_id, p.callback_time payment_time, l.create_time::DATE finish_date_id, l.create_time finish_time,
        total_amount_o+activity_reduce_amount+coupon_reduce_amount order_original_amount, activity_reduce_amount order_activity_amount,
        coupon_reduce_amount order_coupon_amount, total_amount_o order_total_amount, total_amount_o payment_amount
        FROM (SELECT *, total_amount total_amount_o FROM order_info) o LEFT JOIN payment_info p ON p.order_id=o.id AND p.payment_status='1602'
        LEFT JOIN order_status_log l ON l.order_id=o.id AND l.order_status='1004'""",
    "session_1d": """SELECT sid session_id, mid mid_id, ba brand, md model, os operate_system, vc version_code, ch channel, dt,
        sum(during_time) during_time_1d, count(*) page_count_1d FROM page_view GROUP BY ALL""",
    "login_rows": """SELECT uid user_id, ch channel, ar province_id, vc version_code, mid mid_id, ba brand, md model, os operate_system, dt,
        view_ts + INTERVAL 8 HOUR login_time FROM page_view WHERE uid IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY sid ORDER BY view_ts, page_id, item, during_time)=1""",
    "login_td": f"""SELECT u.id::VARCHAR user_id, coalesce(l.last, u.create_time::DATE) login_date_last, u.create_time::DATE login_date_first,
        coalesce(l.n,1) login_count_td, CASE WHEN u.create_time::DATE < {L_DAY} THEN coalesce(l.prev, u.create_time::DATE) END login_date_previous
        FROM user_info u LEFT JOIN (SELECT user_id, max(login_time::DATE) AS last, count(*) n,
        max(login_time::DATE) FILTER (login_time::DATE < {L_DAY}) prev FROM login_rows WHERE login_time::DATE <= {L_DAY} GROUP BY 1) l
        ON l.user_id=u.id::VARCHAR WHERE u.create_time::DATE <= {L_DAY}""",
    "order_td": f"""SELECT user_id, min(dt) order_date_first, max(dt) order_date_last, count(order_id) order_count_td, sum(sku_num) order_num_td,
        sum(split_original_amount) order_original_amount_td, sum(split_activity_amount) activity_reduce_amount_td,
        sum(split_coupon_amount) coupon_reduce_amount_td, sum(split_total_amount) order_total_amount_td
        FROM dwd_line WHERE dt <= {T_DAY} GROUP BY 1""",
    "span3": "SELECT unnest([1,7,30])::BIGINT recent_days",
})

_AMOUNTS = ", ".join(f"{num(c)} {c}" for c in ("order_original_amount_1d", "activity_reduce_amount_1d",
                                                "coupon_reduce_amount_1d", "order_total_amount_1d"))
_SKU = "s.sku_name, s.category1_id, s.category1_name, s.category2_id, s.category2_name, s.category3_id, s.category3_name, s.tm_id, s.tm_name"
_DAY = "strftime({0},'%Y-%m-%d') {1}"
DT = _DAY.format("dt", "dt")


def _day(col: str, out: str | None = None) -> str:
    return f"strftime({col},'%Y-%m-%d') {out or col.split('.')[-1]}"


def _sec(col: str, out: str | None = None) -> str:
    return f"strftime({col},'%Y-%m-%d %H:%M:%S') {out or col.split('.')[-1]}"


# ---- dimensions ---------------------------------------------------------------------------

@query("dim_sku", f"""SELECT s.id, {num('price')} price, weight, s.spu_id, s.spu_name, {_SKU}, a.id attr_id, a.attr_name,
    a.value_name attr_value_name, b.id sale_attr_id, b.sale_attr_name, b.sale_attr_value_name FROM dim_sku s
    LEFT JOIN sku_attr a ON a.sku_id=s.id LEFT JOIN sku_sale_attr b ON b.sku_id=s.id""")
def _(t):
    return dims.sku_dim(t.sku_info, t.spu_info, dims.category_levels(t.category3, t.category2, t.category1),
                        t.trademark, t.sku_attr, t.sku_sale_attr)


@query("dim_category_levels", """SELECT c3.id category3_id, c3.name category3_name, c2.id category2_id, c2.name category2_name,
    c1.id category1_id, c1.name category1_name FROM category3 c3 LEFT JOIN category2 c2 ON c2.id=c3.category2_id
    LEFT JOIN category1 c1 ON c1.id=c2.category1_id""")
def _(t):
    return dims.category_levels(t.category3, t.category2, t.category1)


@query("dim_coupon", "SELECT * FROM dim_coupon")
def _(t):
    return dims.coupon_dim(t.coupon_info, t.dictionary)


@query("dim_activity", """SELECT r.*, i.activity_name, d.dic_name activity_type_name, CASE activity_type
    WHEN '3101' THEN '满'||condition_amount||'元减'||benefit_amount||'元' WHEN '3102' THEN '满'||condition_num||'件打'||benefit_discount||' 折'
    WHEN '3103' THEN '打'||benefit_discount||'折' END benefit_rule FROM activity_rule r LEFT JOIN activity_info i ON i.id=r.activity_id
    LEFT JOIN dictionary d ON d.parent_code='31' AND d.dic_code=activity_type""")
def _(t):
    return dims.activity_dim(t.activity_rule, t.activity_info, t.dictionary)


@query("dim_province", "SELECT id, province_name, area_code, iso_code, iso_3166_2, region_id, region_name FROM dim_province")
def _(t):
    return dims.province_dim(t.province, t.region)


@query("dim_promotion_position", "SELECT * FROM promotion_pos")
def _(t):
    return dims.promotion_position_dim(t.promotion_pos)


@query("dim_promotion_referrer", "SELECT * FROM promotion_refer")
def _(t):
    return dims.promotion_referrer_dim(t.promotion_refer)


@query("dim_date", f"""SELECT strftime(d,'%Y%m%d') date_id, {_day('d','"day"')}, weekofyear(d)::BIGINT week_id, isodow(d)::BIGINT week_day,
    day(d)::BIGINT day_of_month, month(d)::BIGINT "month", quarter(d)::BIGINT "quarter", year(d)::BIGINT "year",
    CASE WHEN isodow(d)<=5 THEN '1' ELSE '0' END is_workday
    FROM (SELECT unnest(generate_series(min(ordered), max(ordered), INTERVAL 1 DAY))::DATE d FROM heads)""")
def _(t):
    bounds = t.heads.agg(F.to_date(F.min("ordered")).alias("first_day"), F.to_date(F.max("ordered")).alias("last_day"))
    return dims.date_dim(bounds)


@query("dim_user_zip", f"""SELECT id, name, phone_num, email, user_level, birthday, gender, {_sec('create_time')},
    '{LOG_DAY}' start_date, '9999-12-31' end_date FROM user_info""")
def _(t):
    return dims.user_zip(t.user_info, log_day())


@query("dim_user_zip_merge", f"""WITH old AS (SELECT id, user_level, email, DATE '2024-01-15' s FROM user_info WHERE id%5<>0),
    new AS (SELECT id, CASE WHEN id%4=0 THEN 'GOLD' ELSE user_level END user_level, email FROM user_info WHERE id%7<>0),
    j AS (SELECT o.id oid, o.user_level ol, o.email oe, o.s, n.id nid, n.user_level nl, n.email ne,
        (n.id IS NULL OR (o.user_level=n.user_level AND o.email=n.email)) keep FROM old o FULL JOIN new n ON o.id=n.id)
    SELECT oid id, ol user_level, oe email, {_day('s','start_date')},
        CASE WHEN keep THEN '9999-12-31' ELSE strftime({L_DAY} - 1,'%Y-%m-%d') END end_date FROM j WHERE oid IS NOT NULL
    UNION ALL SELECT nid, nl, ne, '{LOG_DAY}', '9999-12-31' FROM j WHERE nid IS NOT NULL AND (oid IS NULL OR NOT keep)""")
def _(t):
    users = t.user_info.select("id", "user_level", "email")
    old = history.open_versions(users.filter(F.col("id") % 5 != 0), F.lit("2024-01-15").cast("date"))
    new = users.filter(F.col("id") % 7 != 0).withColumn(
        "user_level", F.when(F.col("id") % 4 == 0, "GOLD").otherwise(F.col("user_level")))
    return history.merge_versions(old, new, ["id"], ["user_level", "email"], log_day())


@query("dim_customer_versions", f"""SELECT o_custkey user_id, o_orderpriority user_level, {_day('ordered::DATE','start_date')},
    strftime(coalesce((lead(ordered) OVER w)::DATE - 1, DATE '9999-12-31'),'%Y-%m-%d') end_date
    FROM (SELECT * FROM heads QUALIFY row_number() OVER (PARTITION BY o_custkey, ordered::DATE ORDER BY ordered DESC, o_orderkey DESC)=1)
    WINDOW w AS (PARTITION BY o_custkey ORDER BY ordered, o_orderkey)""")
def _(t):
    changes = t.heads.select(F.col("o_custkey").alias("user_id"), F.col("o_orderpriority").alias("user_level"),
                             "ordered", "o_orderkey")
    return history.versions_from_changes(changes, ["user_id"], "ordered", ["o_orderkey"], slice_seconds=365 * 86_400) \
        .drop("ordered", "o_orderkey")


@query("dim_customer_versions_kept", f"""SELECT count(*) n, count(*) FILTER (start_date > end_date) turned FROM (
    SELECT ordered::DATE start_date, coalesce((lead(ordered) OVER w)::DATE - 1, DATE '9999-12-31') end_date FROM (
        SELECT * FROM heads QUALIFY row_number() OVER (PARTITION BY o_custkey, ordered::DATE ORDER BY ordered DESC, o_orderkey DESC)=1)
    WINDOW w AS (PARTITION BY o_custkey ORDER BY ordered, o_orderkey))""")
def _(t):
    changes = t.heads.select(F.col("o_custkey").alias("user_id"), "ordered", "o_orderkey")
    kept = history.versions_from_changes(changes, ["user_id"], "ordered", ["o_orderkey"], slice_seconds=365 * 86_400)
    return kept.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("start_date") > F.col("end_date")).alias("turned"))


# ---- facts ---------------------------------------------------------------------------------

@query("fact_cart_add", f"SELECT id, user_id, sku_id, {_day('create_time','date_id')}, {_sec('create_time')}, sku_num, {_day('create_time','dt')} FROM cart_info")
def _(t):
    return facts.cart_add_fact(t.cart_info)


@query("fact_cart_snapshot", "SELECT id, user_id, sku_id, sku_name, sku_num FROM cart_info WHERE is_ordered=0")
def _(t):
    return facts.cart_snapshot(t.cart_info)


@query("fact_order_detail", f"""SELECT id, order_id, user_id, sku_id, province_id, activity_id, activity_rule_id, coupon_id, {_day('dt','date_id')},
    {_sec('create_time')}, sku_num, {num('split_original_amount')} split_original_amount, {num('split_activity_amount')} split_activity_amount,
    {num('split_coupon_amount')} split_coupon_amount, {num('split_total_amount')} split_total_amount, {DT} FROM dwd_order_detail""")
def _(t):
    return order_detail(t)


@query("fact_payment_success", f"""SELECT id, order_id, user_id, sku_id, province_id, activity_id, activity_rule_id, coupon_id, payment_type_code,
    payment_type_name, {_day('date_id')}, {_sec('callback_time')}, sku_num, {num('split_original_amount')} split_original_amount,
    {num('split_activity_amount')} split_activity_amount, {num('split_coupon_amount')} split_coupon_amount,
    {num('split_payment_amount')} split_payment_amount FROM dwd_pay""")
def _(t):
    return facts.payment_success_fact(order_detail(t), t.payment_info, t.dictionary)


@query("fact_trade_flow", f"""SELECT order_id, user_id, province_id, {_day('order_date_id')}, {_sec('order_time')}, {_day('payment_date_id')},
    {_sec('payment_time')}, {_day('finish_date_id')}, {_sec('finish_time')}, {num('order_original_amount')} order_original_amount,
    {num('order_activity_amount')} order_activity_amount, {num('order_coupon_amount')} order_coupon_amount,
    {num('order_total_amount')} order_total_amount, {num('payment_amount')} payment_amount FROM trade_flow""")
def _(t):
    return facts.trade_flow(t.order_info, t.payment_info, t.order_status_log)


@query("fact_coupon_used", f"SELECT id, coupon_id, user_id, order_id, {_day('used_time','date_id')}, {_sec('used_time','payment_time')}, {_day('used_time','dt')} FROM coupon_use WHERE used_time IS NOT NULL")
def _(t):
    return facts.coupon_used_fact(t.coupon_use)


@query("fact_favor_add", f"SELECT id, user_id, sku_id, {_day('create_time','date_id')}, {_sec('create_time')}, {_day('create_time','dt')} FROM favor_info WHERE is_cancel='0'")
def _(t):
    return facts.favor_add_fact(t.favor_info)


@query("fact_page_view", f"""SELECT ar province_id, ba brand, ch channel, is_new, md model, mid mid_id, os operate_system, uid user_id,
    vc version_code, item page_item, item_type page_item_type, NULL::VARCHAR last_page_id, page_id, NULL::VARCHAR from_pos_id,
    NULL::VARCHAR from_pos_seq, NULL::VARCHAR refer_id, {_day('dt','date_id')}, {_sec('view_ts','view_time')}, sid session_id, during_time, {DT}
    FROM page_view""")
def _(t):
    return views(t)


_DEV = "channel, province_id, version_code, mid_id, brand, model, operate_system"


@query("fact_register", f"""SELECT u.id user_id, {_day('create_time','date_id')}, {_sec('create_time')}, {_DEV} FROM user_info u LEFT JOIN (
    SELECT uid, ch channel, ar province_id, vc version_code, mid mid_id, ba brand, md model, os operate_system FROM page_view
    WHERE uid IS NOT NULL QUALIFY row_number() OVER (PARTITION BY uid ORDER BY view_ts, mid, item, page_id)=1) l ON l.uid=u.id::VARCHAR""")
def _(t):
    return facts.register_fact(t.user_info, views(t))


@query("fact_login", f"SELECT user_id, {_day('login_time','date_id')}, {_sec('login_time')}, {_DEV}, {DT} FROM login_rows")
def _(t):
    return facts.login_fact(views(t))


# ---- summaries -----------------------------------------------------------------------------

@query("daily_user_sku_order", f"""SELECT user_id, sku_id, {DT}, {_SKU}, order_count_1d, {big('order_num_1d')} order_num_1d, {_AMOUNTS}
    FROM dws_user_sku d LEFT JOIN dim_sku s ON s.id=d.sku_id""")
def _(t):
    return daily.user_sku_order_daily(lines(t), sku(t))


@query("daily_user_order", f"""SELECT user_id, {DT}, count(order_id) order_count_1d, {big('sum(sku_num)')} order_num_1d,
    {num('sum(split_original_amount)')} order_original_amount_1d, {num('sum(split_activity_amount)')} activity_reduce_amount_1d,
    {num('sum(split_coupon_amount)')} coupon_reduce_amount_1d, {num('sum(split_total_amount)')} order_total_amount_1d
    FROM dwd_line GROUP BY user_id, dt""")
def _(t):
    return daily.user_order_daily(lines(t))


@query("daily_user_cart", f"""SELECT user_id, {_day('create_time::DATE','dt')}, count(*) cart_add_count_1d, {big('sum(sku_num)')} cart_add_num_1d
    FROM cart_info GROUP BY user_id, create_time::DATE""")
def _(t):
    return daily.user_cart_daily(facts.cart_add_fact(t.cart_info))


@query("daily_user_payment", f"""SELECT user_id, {_day('date_id','dt')}, count(DISTINCT order_id) payment_count_1d, {big('sum(sku_num)')} payment_num_1d,
    {num('sum(split_payment_amount)')} payment_amount_1d FROM dwd_pay WHERE order_id IS NOT NULL GROUP BY user_id, date_id""")
def _(t):
    core = facts.order_line_core(t.order_detail, t.order_head, ["user_id"])
    for name in ("province_id", "activity_id", "activity_rule_id", "coupon_id"):
        core = core.withColumn(name, F.lit(None).cast("bigint"))
    return daily.user_payment_daily(facts.payment_success_fact(core, t.payment_info, t.dictionary, how="inner"))


@query("daily_province_order", f"""SELECT d.province_id, {DT}, p.province_name, p.area_code, p.iso_code, p.iso_3166_2, order_count_1d, {_AMOUNTS}
    FROM dws_province d LEFT JOIN dim_province p ON p.id=d.province_id""")
def _(t):
    return daily.province_order_daily(province_lines(t), dims.province_dim(t.province, t.region))


@query("daily_coupon_used", f"""SELECT user_id, coupon_id, {_day('u.d','dt')}, n used_count_1d, coupon_name, coupon_type, coupon_type_name, benefit_rule
    FROM (SELECT user_id, coupon_id, used_time::DATE d, count(*) n FROM coupon_use WHERE used_time IS NOT NULL GROUP BY ALL) u
    LEFT JOIN dim_coupon c ON c.id=u.coupon_id""")
def _(t):
    return daily.coupon_used_daily(facts.coupon_used_fact(t.coupon_use), dims.coupon_dim(t.coupon_info, t.dictionary))


CTES["favor_1d"] = f"""SELECT f.sku_id, f.d dt, n favor_add_count_1d, {_SKU} FROM (SELECT sku_id, create_time::DATE d, count(*) n
    FROM favor_info WHERE is_cancel='0' GROUP BY ALL) f LEFT JOIN dim_sku s ON s.id=f.sku_id"""


@query("daily_sku_favor", f"SELECT * REPLACE (strftime(dt,'%Y-%m-%d') AS dt) FROM favor_1d")
def _(t):
    return daily.sku_favor_daily(facts.favor_add_fact(t.favor_info), sku(t))


@query("daily_session", f"SELECT * REPLACE (strftime(dt,'%Y-%m-%d') AS dt, during_time_1d::BIGINT AS during_time_1d) FROM session_1d")
def _(t):
    return daily.session_daily(views(t))


@query("daily_page_visitor", f"""SELECT mid mid_id, ba brand, md model, os operate_system, page_id, {DT}, {big('sum(during_time)')} during_time_1d,
    count(*) view_count_1d FROM page_view GROUP BY mid, ba, md, os, page_id, dt""")
def _(t):
    return daily.page_visitor_daily(views(t))


def _wide(cols, day, spans=(7, 30)):
    out = []
    for n in spans:
        for c in cols:
            kind = big if c in ("order_count", "order_num") else num
            out.append(kind(f"coalesce(sum({c}_1d) FILTER ({day}-dt < {n}),0)") + f" {c}_{n}d")
    return ", ".join(out)


_ND = ["order_count", "order_num", "order_original_amount", "activity_reduce_amount", "coupon_reduce_amount", "order_total_amount"]


@query("recent_user_sku_order", f"""WITH w AS (SELECT user_id, sku_id, {_wide(_ND, T_DAY)} FROM dws_user_sku
    WHERE dt <= {T_DAY} AND dt > {T_DAY}-30 GROUP BY 1,2) SELECT w.*, {_SKU} FROM w LEFT JOIN dim_sku s ON s.id=w.sku_id""")
def _(t):
    return daily.user_sku_order_recent(lines(t), sku(t), trade_day())


@query("recent_province_order", f"""WITH w AS (SELECT province_id, {_wide([c for c in _ND if c != 'order_num'], T_DAY)} FROM dws_province
    WHERE dt <= {T_DAY} AND dt > {T_DAY}-30 GROUP BY 1) SELECT w.*, province_name, area_code, iso_code, iso_3166_2
    FROM w LEFT JOIN dim_province p ON p.id=w.province_id""")
def _(t):
    return daily.province_order_recent(province_lines(t), dims.province_dim(t.province, t.region), trade_day())


@query("todate_user_order", f"""SELECT user_id, {_day('order_date_first')}, {_day('order_date_last')}, order_count_td, {big('order_num_td')} order_num_td,
    {num('order_original_amount_td')} order_original_amount_td, {num('activity_reduce_amount_td')} activity_reduce_amount_td,
    {num('coupon_reduce_amount_td')} coupon_reduce_amount_td, {num('order_total_amount_td')} order_total_amount_td FROM order_td""")
def _(t):
    return daily.user_order_to_date(lines(t), trade_day())


@query("todate_user_login", f"SELECT user_id, {_day('login_date_last')}, {_day('login_date_first')}, login_count_td, {_day('login_date_previous')} FROM login_td")
def _(t):
    return daily.user_login_to_date(t.user_info, logins(t), log_day())


# ---- reports -------------------------------------------------------------------------------

@query("report_traffic_by_channel", f"""SELECT '{LOG_DAY}' dt, recent_days, channel, count(DISTINCT mid_id) uv_count,
    floor(sum(during_time_1d)::DOUBLE/count(*)/1000)::BIGINT avg_duration_sec, floor(sum(page_count_1d)::DOUBLE/count(*))::BIGINT avg_page_count,
    count(*) sv_count, {half_up('count(*) FILTER (page_count_1d=1)', 'count(*)', 2)} bounce_rate
    FROM session_1d, span3 WHERE dt <= {L_DAY} AND dt > {L_DAY}-recent_days::INT GROUP BY recent_days, channel""")
def _(t):
    return reports.traffic_by_channel(daily.session_daily(views(t)), log_day())


@query("report_page_paths", f"""SELECT {DT}, source, coalesce(target,'null') target, count(*) path_count FROM (
    SELECT dt, 'step-'||n||':'||page_id source, 'step-'||(n+1)||':'||nxt target FROM (SELECT dt, page_id, row_number() OVER w n, lead(page_id) OVER w nxt
    FROM page_view WINDOW w AS (PARTITION BY dt, sid ORDER BY view_ts NULLS FIRST, item NULLS FIRST, during_time NULLS FIRST, page_id NULLS FIRST))) GROUP BY dt, source, target""")
def _(t):
    return reports.page_paths(views(t))


def login_td(t):
    return daily.user_login_to_date(t.user_info, logins(t), log_day())


@query("report_user_change", f"""SELECT '{LOG_DAY}' dt, count(*) FILTER (login_date_last = {L_DAY}-7) user_churn_count,
    count(*) FILTER (login_date_last = {L_DAY} AND login_date_last-login_date_previous >= 8) user_back_count FROM login_td""")
def _(t):
    return reports.user_change(login_td(t), log_day())


@query("report_user_retention", f"""SELECT '{LOG_DAY}' dt, {_day('login_date_first','create_date')}, ({L_DAY}-login_date_first)::BIGINT retention_day,
    count(*) FILTER (login_date_last={L_DAY}) retention_count, count(*) new_user_count,
    {half_up(f'100*count(*) FILTER (login_date_last={L_DAY})', 'count(*)', 2)} retention_rate FROM login_td
    WHERE login_date_first >= {L_DAY}-7 AND login_date_first < {L_DAY} GROUP BY login_date_first""")
def _(t):
    return reports.user_retention(login_td(t), log_day())


@query("report_user_stats", f"""SELECT '{LOG_DAY}' dt, recent_days, count(*) FILTER (login_date_first > {L_DAY}-recent_days::INT) new_user_count,
    count(*) active_user_count FROM login_td, span3 WHERE login_date_last > {L_DAY}-recent_days::INT GROUP BY recent_days""")
def _(t):
    return reports.user_stats(login_td(t), log_day())


def _days(df, user, ts):
    return df.groupBy(user, F.to_date(ts).alias("dt")).agg(F.count(F.lit(1)).alias("n"))


@query("report_action_funnel", f"""WITH p AS (SELECT DISTINCT mid, ba, md, os, page_id, dt FROM page_view),
    d AS (SELECT DISTINCT ts::DATE dt FROM ev) SELECT strftime(d.dt,'%Y-%m-%d') dt,
    (SELECT count(*) FROM p WHERE p.dt=d.dt AND page_id='home') home_count, (SELECT count(*) FROM p WHERE p.dt=d.dt AND page_id='good_detail') good_detail_count,
    (SELECT count(DISTINCT user_id) FROM cart_info WHERE create_time::DATE=d.dt) cart_count,
    (SELECT count(DISTINCT user_id) FROM product_order WHERE order_time::DATE=d.dt) order_count,
    (SELECT count(DISTINCT user_id) FROM product_order WHERE order_id%4<>0 AND order_time::DATE=d.dt) payment_count FROM d""")
def _(t):
    paid = t.product_order.filter(F.col("order_id") % 4 != 0)
    return reports.action_funnel(
        daily.page_visitor_daily(views(t)), daily.user_cart_daily(facts.cart_add_fact(t.cart_info)),
        _days(t.product_order, "user_id", "order_time"), _days(paid, "user_id", "order_time"))


@query("report_new_order_users", f"""SELECT '{TRADE_DAY}' dt, recent_days, (SELECT count(*) FROM order_td
    WHERE order_date_first > {T_DAY}-recent_days::INT) new_order_user_count FROM span3""")
def _(t):
    return reports.new_order_users(daily.user_order_to_date(lines(t), trade_day()), trade_day())


@query("report_consecutive_buyers", f"""SELECT '{LOG_DAY}' dt, 7::BIGINT recent_days, count(DISTINCT user_id) order_continuously_user_count FROM (
    SELECT user_id, lead(dt,2) OVER (PARTITION BY user_id ORDER BY dt)-dt g FROM (SELECT DISTINCT user_id, order_time::DATE dt FROM product_order
    WHERE order_time::DATE <= {L_DAY} AND order_time::DATE > {L_DAY}-7)) WHERE g=2""")
def _(t):
    return reports.consecutive_buyers(_days(t.product_order, "user_id", "order_time"), log_day())


@query("report_repeat_rate_by_brand", f"""SELECT '{TRADE_DAY}' dt, 30::BIGINT recent_days, tm_id, tm_name,
    {half_up('count(*) FILTER (n>=2)', 'count(*)', 2)} order_repeat_rate FROM (SELECT tm_id, tm_name, user_id, sum(order_count_1d) n
    FROM dws_user_sku d LEFT JOIN dim_sku s ON s.id=d.sku_id WHERE dt <= {T_DAY} AND dt > {T_DAY}-30 GROUP BY ALL) GROUP BY tm_id, tm_name""")
def _(t):
    return reports.repeat_rate_by_brand(daily.user_sku_orders(lines(t)), sku(t), trade_day())


def _orders_by_sql(keys):
    return f"""SELECT '{TRADE_DAY}' dt, recent_days, {keys}, {big('sum(order_count_1d)')} order_count, count(DISTINCT user_id) order_user_count
    FROM span3, dws_user_sku d LEFT JOIN dim_sku s ON s.id=d.sku_id WHERE dt <= {T_DAY} AND dt > {T_DAY}-recent_days::INT GROUP BY ALL"""


@query("report_orders_by_brand", _orders_by_sql("tm_id, tm_name"))
def _(t):
    return reports.orders_by_brand(daily.user_sku_orders(lines(t)), sku(t), trade_day())


@query("report_orders_by_category", _orders_by_sql("category1_id, category1_name, category2_id, category2_name, category3_id, category3_name"))
def _(t):
    return reports.orders_by_category(daily.user_sku_orders(lines(t)), sku(t), trade_day())


@query("report_top_cart_sku", f"""SELECT sku_id, {big('n')} cart_num, s.sku_name, category1_id, category1_name, category2_id, category2_name, category3_id, category3_name,
    rank() OVER (PARTITION BY category1_id, category2_id, category3_id ORDER BY n DESC) rk FROM (SELECT sku_id, sum(sku_num) n
    FROM cart_info WHERE is_ordered=0 GROUP BY 1) c LEFT JOIN dim_sku s ON s.id=c.sku_id QUALIFY rk<=3""")
def _(t):
    return reports.top_cart_sku_by_category(facts.cart_snapshot(t.cart_info), sku(t))


@query("report_top_favor_sku", f"""SELECT {DT}, tm_id, tm_name, sku_id, sku_name, favor_add_count_1d favor_count,
    rank() OVER (PARTITION BY dt, tm_id ORDER BY favor_add_count_1d DESC) rk FROM favor_1d QUALIFY rk<=3""")
def _(t):
    return reports.top_favor_sku_by_brand(daily.sku_favor_daily(facts.favor_add_fact(t.favor_info), sku(t)))


@query("report_order_to_pay", f"""SELECT {_day('payment_date_id','dt')}, floor(sum(epoch(payment_time)-epoch(order_time))::DOUBLE/count(*))::BIGINT order_to_pay_interval_avg
    FROM trade_flow WHERE payment_time IS NOT NULL GROUP BY payment_date_id""")
def _(t):
    flow = facts.trade_flow(t.order_head.withColumn("province_id", F.lit(None).cast("bigint")), t.payment_info, t.order_status_log)
    return reports.order_to_pay_seconds(flow)


@query("report_orders_by_province", f"""WITH w AS (SELECT recent_days, province_id, {big('sum(order_count_1d)')} order_count, {num('sum(order_total_amount_1d)')} order_total_amount
    FROM dws_province, span3 WHERE dt <= {T_DAY} AND dt > {T_DAY}-recent_days::INT GROUP BY 1,2)
    SELECT '{TRADE_DAY}' dt, w.*, province_name, area_code, iso_code, iso_3166_2 FROM w LEFT JOIN dim_province p ON p.id=w.province_id""")
def _(t):
    return reports.orders_by_province(province_lines(t), dims.province_dim(t.province, t.region), trade_day())


@query("report_coupon_stats", f"""SELECT strftime(u.d,'%Y-%m-%d') dt, coupon_id, coupon_name, {big('sum(n)')} used_count, count(*) used_user_count
    FROM (SELECT user_id, coupon_id, used_time::DATE d, count(*) n FROM coupon_use WHERE used_time IS NOT NULL GROUP BY ALL) u
    LEFT JOIN dim_coupon c ON c.id=u.coupon_id GROUP BY u.d, coupon_id, coupon_name""")
def _(t):
    return reports.coupon_stats(daily.coupon_used_daily(facts.coupon_used_fact(t.coupon_use), dims.coupon_dim(t.coupon_info, t.dictionary)))
