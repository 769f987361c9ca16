"""User labels in batch form."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..bridge.sql import CTES
from ..bridge.tables import Inputs
from ..plans import persona
from ..streaming import ingest, profile
from .base import query
from .retail import L_DAY, _day, log_day


def _scores_sql(factor: str, value: str, table, weight, other=None) -> str:
    """CASE expressions of the six bands of a factor as exact decimals."""
    out = []
    for i, band in enumerate(_BANDS):
        cases = " ".join(f"WHEN '{v}' THEN round({s[i]}::DECIMAL(4,2)*{weight}::DECIMAL(4,2),3)" for v, s in table.items())
        rest = f" ELSE CASE WHEN {value}<>'' THEN round({other[i]}::DECIMAL(4,2)*{weight}::DECIMAL(4,2),3) END" if other else ""
        out.append(f"(CASE {value} {cases}{rest} END)::DECIMAL(8,3) {factor}_{band}")
    return ", ".join(out)


# Fixed values, written out here so that the SQL doesn't depend on the code that it checks.
_BANDS = ('18_24', '25_29', '30_34', '35_39', '40_49', '50')
_DEVICE_SQL = _scores_sql('device', 'judge_os', {
    'iOS': ('0.7', '0.6', '0.5', '0.4', '0.3', '0.2'),
    'Android': ('0.8', '0.7', '0.6', '0.5', '0.4', '0.3')}, '0.1')
_SEARCH_SQL = _scores_sql('search', 'search_category', {
    '时尚与潮流': ('0.9', '0.7', '0.5', '0.3', '0.2', '0.1'),
    '性价比': ('0.2', '0.4', '0.6', '0.7', '0.8', '0.8'),
    '健康与养生': ('0.1', '0.2', '0.4', '0.6', '0.8', '0.7'),
    '家庭与育儿': ('0.1', '0.2', '0.4', '0.6', '0.8', '0.7'),
    '科技与数码': ('0.8', '0.6', '0.4', '0.3', '0.2', '0.1'),
    '学习与发展': ('0.4', '0.5', '0.6', '0.7', '0.8', '0.7')}, '0.15', ('0', '0', '0', '0', '0', '0'))
_ORDER_SQL = ", ".join([
    _scores_sql('pay_time', 'pay_time_slot', {
    '凌晨': ('0.2', '0.1', '0.1', '0.1', '0.1', '0.1'),
    '早晨': ('0.1', '0.1', '0.1', '0.1', '0.2', '0.3'),
    '上午': ('0.2', '0.2', '0.2', '0.2', '0.3', '0.4'),
    '中午': ('0.4', '0.4', '0.4', '0.4', '0.4', '0.3'),
    '下午': ('0.4', '0.5', '0.5', '0.5', '0.5', '0.4'),
    '晚上': ('0.8', '0.7', '0.6', '0.5', '0.4', '0.3'),
    '夜间': ('0.9', '0.7', '0.5', '0.3', '0.2', '0.1')}, '0.1'),
    _scores_sql('amount', 'spending_pow', {
    'low': ('0.8', '0.6', '0.4', '0.3', '0.2', '0.1'),
    'middle': ('0.2', '0.4', '0.6', '0.7', '0.8', '0.7'),
    'high': ('0.1', '0.2', '0.3', '0.4', '0.5', '0.6')}, '0.15'),
    _scores_sql('tname', 'tname', {
    'TCL': ('0.2', '0.3', '0.4', '0.5', '0.6', '0.7'),
    '苹果': ('0.9', '0.8', '0.7', '0.7', '0.7', '0.5'),
    '联想': ('0.9', '0.8', '0.7', '0.7', '0.7', '0.5'),
    '小米': ('0.9', '0.8', '0.7', '0.7', '0.7', '0.5'),
    '欧莱雅': ('0.5', '0.6', '0.8', '0.8', '0.9', '0.2'),
    '香奈儿': ('0.3', '0.4', '0.6', '0.8', '0.9', '0.2')}, '0.2', ('0.1', '0.2', '0.3', '0.4', '0.5', '0.6')),
    _scores_sql('b1name', 'b1_name', {
    '数码': ('0.9', '0.8', '0.6', '0.4', '0.2', '0.1'),
    '手机': ('0.9', '0.8', '0.6', '0.4', '0.2', '0.1'),
    '电脑办公': ('0.9', '0.8', '0.6', '0.4', '0.2', '0.1'),
    '个护化妆': ('0.9', '0.8', '0.6', '0.4', '0.2', '0.1'),
    '服饰内衣': ('0.9', '0.8', '0.6', '0.4', '0.2', '0.1'),
    '家居家装': ('0.2', '0.4', '0.6', '0.8', '0.9', '0.7'),
    '图书、音像、电子书刊': ('0.2', '0.4', '0.6', '0.8', '0.9', '0.7'),
    '厨具': ('0.2', '0.4', '0.6', '0.8', '0.9', '0.7'),
    '鞋靴': ('0.2', '0.4', '0.6', '0.8', '0.9', '0.7'),
    '母婴': ('0.2', '0.4', '0.6', '0.8', '0.9', '0.7'),
    '汽车用品': ('0.2', '0.4', '0.6', '0.8', '0.9', '0.7'),
    '珠宝': ('0.2', '0.4', '0.6', '0.8', '0.9', '0.7'),
    '家用电器': ('0.2', '0.4', '0.6', '0.8', '0.9', '0.7')}, '0.3', ('0.1', '0.2', '0.4', '0.5', '0.8', '0.9'))])
_SUMS = ", ".join("(" + "+".join(f"coalesce({f}_{b},0)" for f in ('device', 'search', 'pay_time', 'amount', 'tname', 'b1name')) + f")::DECIMAL(8,3) sum_{b}" for b in _BANDS)
_ZODIAC = "CASE " + " ".join(f"WHEN month(b)*100+day(b) <= {end} THEN '{name}'" for end, name in (
    (119, "摩羯座"), (218, "水瓶座"), (320, "双鱼座"), (419, "白羊座"), (520, "金牛座"), (621, "双子座"), (722, "巨蟹座"),
    (822, "狮子座"), (922, "处女座"), (1023, "天秤座"), (1122, "天蝎座"), (1221, "射手座"))) + " ELSE '摩羯座' END"

CTES.update({
    "l_cat": "SELECT DISTINCT p_size::BIGINT id, p_size::VARCHAR b3name, ['手机','家用电器','箱包'][(p_size%10%3+1)::INT] b1name FROM part",
    "l_cmp": """SELECT DISTINCT ['手机','家用电器','箱包'][(p_size%10%3+1)::INT] category_name,
        ['科技与数码','性价比','户外'][(p_size%10%3+1)::INT] search_category FROM part""",
    "l_sku": "SELECT p_partkey skuid, p_size::BIGINT c3id, ['TCL','苹果','小米','欧莱雅','香奈儿','其它'][(p_partkey%6+1)::INT] tname FROM part",
    "l_lines": """SELECT detail_id, o_orderkey order_id, l_partkey sku_id, 'sku-'||l_partkey sku_name, qty sku_num, (o_custkey%150)::VARCHAR uid,
        epoch_ms(ordered)+o_orderkey%24*3600000 create_time, (o_orderkey%5000)::DECIMAL(16,2) total_amount FROM lines JOIN heads ON l_orderkey=o_orderkey""",
    "l_profile": """SELECT uid, count(*) pv, string_agg(DISTINCT split_part(os,' ',1), ',' ORDER BY split_part(os,' ',1)) os, string_agg(DISTINCT ch, ',' ORDER BY ch) ch,
        string_agg(DISTINCT md, ',' ORDER BY md) md, string_agg(DISTINCT ba, ',' ORDER BY ba) ba,
        coalesce(string_agg(DISTINCT item, ',' ORDER BY item) FILTER (item_type='keyword' AND NOT is_start),'') search_item,
        arg_max(item, ms) FILTER (item_type='keyword' AND NOT is_start) last_search, max(ms) ts_ms FROM log_all WHERE NOT broken AND uid IS NOT NULL GROUP BY uid""",
    "l_device": f"""SELECT *, {_DEVICE_SQL}, {_SEARCH_SQL} FROM (SELECT p.*, split_part(os,',',1) judge_os, c.b1name b1_category,
        coalesce(m.search_category,'unknown') search_category FROM l_profile p LEFT JOIN l_cat c ON c.b3name=p.last_search LEFT JOIN l_cmp m ON m.category_name=c.b1name)""",
    "l_order": f"""SELECT *, {_ORDER_SQL} FROM (SELECT l.*, c3id, tname, b1name b1_name, CASE WHEN total_amount<1000 THEN 'low' WHEN total_amount<4000 THEN 'middle' ELSE 'high' END spending_pow,
        CASE WHEN h<6 THEN '凌晨' WHEN h<9 THEN '早晨' WHEN h<12 THEN '上午' WHEN h<14 THEN '中午' WHEN h<18 THEN '下午' WHEN h<22 THEN '晚上' ELSE '夜间' END pay_time_slot
        FROM (SELECT *, (create_time//3600000 + 8) % 24 h FROM l_lines) l LEFT JOIN l_sku s ON s.skuid=l.sku_id LEFT JOIN l_cat c ON c.id=s.c3id)""",
    "l_user": f"""SELECT *, {_ZODIAC} zodiac_sign, (year(b)-year(b)%10)::BIGINT AS decade, (year({L_DAY})-year(b)-CASE WHEN month({L_DAY})*100+day({L_DAY}) >= month(b)*100+day(b)
        THEN 0 ELSE 1 END)::BIGINT age FROM (SELECT id::VARCHAR uid, name uname, user_level, login_name, phone_num, email, coalesce(gender,'home') gender,
        DATE '1970-01-01'+birthday::INT b FROM user_info)""",
    "l_sum": f"""SELECT o.*, d.pv, d.os, d.ch, d.md, d.ba, d.search_item, d.judge_os, {_SUMS} FROM l_order o JOIN l_device d ON d.uid=o.uid""",
    "l_body": "SELECT c_custkey::VARCHAR uid, (c_custkey%50+150)::VARCHAR height, (c_custkey%40+45)::VARCHAR weight FROM customer",
})


def profiles(t: Inputs):
    logs = ingest.page_logs(t.raw_log, "log")
    return profile.profile_rows(profile.attribute_counts(profile.known_users(profile.device_and_search(logs))))


def device_scores(t: Inputs):
    return persona.device_search_scores(profiles(t), t.label_categories, t.label_compare)


def order_scores(t: Inputs):
    return persona.order_scores(t.label_lines, t.label_skus, t.label_categories)


def labels(t: Inputs):
    return persona.with_body_metrics(persona.profile_labels(t.user_info, log_day()), t.body_metrics)


def _bands(*factors):
    return ", ".join(f"{f}_{b}::DOUBLE {f}_{b}" for f in factors for b in persona.BANDS)


@query("label_user_profile", "SELECT * FROM l_profile")
def _(t):
    return profiles(t)


@query("label_device_search_scores", f"""SELECT uid, pv, os, ch, md, ba, search_item, last_search, ts_ms, judge_os, b1_category, search_category,
    {_bands('device', 'search')} FROM l_device""")
def _(t):
    return device_scores(t)


@query("label_order_scores", f"""SELECT detail_id, order_id, sku_id, sku_name, sku_num, uid, create_time, total_amount::DOUBLE total_amount, create_time ts_ms, c3id, tname, b1_name,
    spending_pow, pay_time_slot, {_bands('pay_time', 'amount', 'tname', 'b1name')} FROM l_order""")
def _(t):
    return order_scores(t)


@query("label_user_base", f"SELECT * EXCLUDE (b), {_day('b', 'birthday')} FROM l_user")
def _(t):
    return persona.profile_labels(t.user_info, log_day())


@query("label_user_body", f"""SELECT u.* EXCLUDE (b), {_day('b', 'birthday')}, m.height, m.weight, 'cm' unit_height, 'kg' unit_weight FROM l_user u LEFT JOIN l_body m ON m.uid=u.uid""")
def _(t):
    return labels(t)


@query("label_band_sums", f"SELECT uid, detail_id, {', '.join(f'sum_{b}::DOUBLE sum_{b}' for b in persona.BANDS)} FROM l_sum")
def _(t):
    return persona.combine(device_scores(t), order_scores(t)).select("uid", "detail_id", *[f"sum_{b}" for b in persona.BANDS])


_G = "greatest(" + ", ".join(f"sum_{b}" for b in persona.BANDS) + ")"
_BEST = "CASE WHEN " + _G + "<=0 THEN NULL " + " ".join(f"WHEN sum_{b}={_G} THEN '{b}'" for b in persona.BANDS) + " END"


@query("label_document", f"""SELECT s.uid, u.uname, s.create_time ts_ms, u.decade, u.zodiac_sign, u.age, m.height, s.judge_os, s.pv intraday_pv, s.search_item, s.md, s.os,
    s.pay_time_slot login_time_slot, sum_18_24::DOUBLE age_sum_18_24, s.spending_pow, {_BEST} calculate_age, s.sku_name, s.b1_name, s.tname, s.sku_id,
    strftime(epoch_ms(s.create_time),'%Y%m%d') ds FROM l_sum s JOIN l_user u ON u.uid=s.uid LEFT JOIN l_body m ON m.uid=u.uid""")
def _(t):
    doc = persona.label_document(persona.combine(device_scores(t), order_scores(t)), labels(t))
    return doc.select(
        "uid", "uname", "ts_ms", "user_base_label.decade", "user_base_label.zodiac_sign", "user_base_label.age",
        "user_base_label.height", "user_base_label.judge_os", "user_log_label.intraday_pv", "user_log_label.search_item",
        "user_device_label.md", "user_device_label.os", "user_device_label.login_time_slot",
        F.col("user_calculate_label.computer_age_info.age_sum_18_24").alias("age_sum_18_24"),
        "user_calculate_label.spending_pow", "user_calculate_label.calculate_age", "sup_info_message.*", "ds")
