"""Shop behaviour: product days, product board, store entry, and page boards."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..bridge.sql import CTES, big, cents, half_up, num
from ..bridge.tables import Inputs
from ..operators import paths
from ..plans import page_board, product_board as board, product_day as days, store_entry as entry
from .base import query
from .retail import L_DAY, _day, _sec, log_day

_ROLL = f"{L_DAY}-30"
CTES.update({
    "v_visit": f"SELECT v.*, product_name, category_id, category_name FROM product_visit v JOIN product_info p USING (product_id) WHERE stay_seconds>0 AND visit_time >= {_ROLL}",
    "v_fav": f"SELECT f.*, product_name, category_id, category_name FROM product_favorite f JOIN product_info p USING (product_id) WHERE fav_time >= {_ROLL}",
    "v_cart": f"SELECT c.*, product_name, category_id, category_name FROM product_cart c JOIN product_info p USING (product_id) WHERE cart_time >= {_ROLL}",
    "v_order": f"SELECT o.*, product_name, category_id, category_name FROM product_order o JOIN product_info p USING (product_id) WHERE order_time >= {_ROLL}",
    "v_pay": f"""SELECT y.*, product_name, category_id, category_name FROM product_payment y JOIN product_info p USING (product_id)
        JOIN product_order o ON o.order_id=y.order_id WHERE pay_amount>0 AND pay_time >= o.order_time AND pay_time >= {_ROLL}""",
    "v_refund": f"SELECT r.*, product_name, category_id, category_name FROM product_refund r JOIN product_info p USING (product_id) WHERE refund_time >= {_ROLL}",
    "product_1d": f"""SELECT v.*, coalesce(fav_users,0) fav_users, coalesce(cart_users,0) cart_users, cart_qty, coalesce(order_users,0) order_users, order_qty,
        order_amount, coalesce(pay_users,0) pay_users, coalesce(pay_qty,0) pay_qty, pay_amount, coalesce(sale_amount,0) juhuasuan_pay_amount,
        CASE WHEN pay_qty>0 THEN 1 ELSE 0 END::BIGINT active_products, {half_up(cents('pay_amount'), '100*order_qty', 2)} item_unit_price, refund_amount
        FROM (SELECT visit_time::DATE summary_date, product_id, product_name, category_id, category_name, count(DISTINCT user_id) uv, count(*) pv,
            {half_up('sum(stay_seconds)', 'count(*)', 2)}::DECIMAL(16,2) avg_stay_seconds, {half_up('count(*) FILTER (stay_seconds<=3)', 'count(*)', 4)}::DECIMAL(16,4) bounce_rate,
            count(DISTINCT user_id) FILTER (is_micro_detail=1) micro_detail_uv FROM v_visit GROUP BY ALL) v
        LEFT JOIN (SELECT fav_time::DATE summary_date, product_id, count(DISTINCT user_id) fav_users FROM v_fav GROUP BY ALL) USING (summary_date, product_id)
        LEFT JOIN (SELECT cart_time::DATE summary_date, product_id, count(DISTINCT user_id) cart_users, sum(quantity) cart_qty FROM v_cart GROUP BY ALL) USING (summary_date, product_id)
        LEFT JOIN (SELECT order_time::DATE summary_date, product_id, count(DISTINCT user_id) order_users, sum(quantity) order_qty, sum(order_amount) order_amount FROM v_order GROUP BY ALL) USING (summary_date, product_id)
        LEFT JOIN (SELECT pay_time::DATE summary_date, product_id, count(DISTINCT user_id) pay_users, count(*) pay_qty, sum(pay_amount) pay_amount,
            sum(pay_amount) FILTER (activity_type='JUHUASUAN') sale_amount FROM v_pay GROUP BY ALL) USING (summary_date, product_id)
        LEFT JOIN (SELECT refund_time::DATE summary_date, product_id, sum(refund_amount) refund_amount FROM v_refund GROUP BY ALL) USING (summary_date, product_id)""",
    "order_money": """SELECT o.*, o.order_time::DATE summary_date, y.pay_amount, y.pay_user_id, r.refund_amount FROM v_order o
        LEFT JOIN (SELECT order_id, sum(pay_amount) pay_amount, max(user_id) pay_user_id FROM v_pay GROUP BY 1) y USING (order_id)
        LEFT JOIN (SELECT order_id, sum(refund_amount) refund_amount FROM v_refund GROUP BY 1) r USING (order_id)""",
    "trade_1d": """SELECT summary_date, count(DISTINCT user_id) uv, count(DISTINCT order_id) order_count, sum(order_amount) total_order_amount,
        count(DISTINCT pay_user_id) pay_user_count, sum(pay_amount) total_pay_amount, sum(refund_amount) total_refund_amount FROM order_money GROUP BY 1""",
})


class Product:
    """The six recent facts of the product domain."""

    def __init__(self, t: Inputs):
        p, day = t.product_info, log_day()
        self.visits = days.visit_fact(t.product_visit, p, day)
        self.favorites = days.recent_fact(t.product_favorite, p, "fav_time", day)
        self.carts = days.recent_fact(t.product_cart, p, "cart_time", day)
        self.orders = days.recent_fact(t.product_order, p, "order_time", day)
        self.payments = days.payment_fact(t.product_payment, t.product_order, p, day)
        self.refunds = days.recent_fact(t.product_refund, p, "refund_time", day)

    @property
    def all(self):
        return self.visits, self.favorites, self.carts, self.orders, self.payments, self.refunds

    @property
    def money(self):
        return self.orders, self.payments, self.refunds


def _money(*cols):
    return ", ".join(f"{c}::DOUBLE AS {c}" for c in cols)


@query("product_fact_visit", f"SELECT * REPLACE ({_sec('visit_time').replace(' visit_time', ' AS visit_time')}) FROM v_visit")
def _(t):
    return Product(t).visits


@query("product_fact_favorite", "SELECT * REPLACE (strftime(fav_time,'%Y-%m-%d %H:%M:%S') AS fav_time) FROM v_fav")
def _(t):
    return Product(t).favorites


@query("product_fact_cart", "SELECT * REPLACE (strftime(cart_time,'%Y-%m-%d %H:%M:%S') AS cart_time) FROM v_cart")
def _(t):
    return Product(t).carts


@query("product_fact_order", f"SELECT * REPLACE (strftime(order_time,'%Y-%m-%d %H:%M:%S') AS order_time, {_money('order_amount')}) FROM v_order")
def _(t):
    return Product(t).orders


@query("product_fact_payment", f"SELECT * REPLACE (strftime(pay_time,'%Y-%m-%d %H:%M:%S') AS pay_time, {_money('pay_amount')}) FROM v_pay")
def _(t):
    return Product(t).payments


@query("product_fact_refund", f"SELECT *, 'goods' refund_type REPLACE (strftime(refund_time,'%Y-%m-%d %H:%M:%S') AS refund_time, {_money('refund_amount')}) FROM v_refund".replace("*, 'goods' refund_type REPLACE", "* REPLACE").replace(" FROM v_refund", ", 'goods' refund_type FROM v_refund"))
def _(t):
    return Product(t).refunds


@query("product_daily", f"""SELECT * REPLACE (strftime(summary_date,'%Y-%m-%d') AS summary_date, cart_qty::BIGINT AS cart_qty, order_qty::BIGINT AS order_qty,
    {_money('avg_stay_seconds', 'bounce_rate', 'order_amount', 'pay_amount', 'juhuasuan_pay_amount', 'refund_amount')}) FROM product_1d""")
def _(t):
    return days.product_day(*Product(t).all)


_FLAG = """SELECT {ts}::DATE d, user_id, product_id, max(1) {name} FROM {table} GROUP BY ALL"""


@query("product_daily_user", f"""SELECT strftime(v.d,'%Y-%m-%d') summary_date, v.user_id, count(v.product_id) visit_products, {big('sum(pv)')} pv,
    {big('coalesce(sum(fav),0)')} fav_count, {big('coalesce(sum(cart),0)')} cart_count, {big('coalesce(sum(ord),0)')} order_count,
    {big('count(y.n)')} pay_count, {num('coalesce(sum(y.a),0)')} total_pay_amount, {num('coalesce(sum(r.a),0)')} total_refund_amount
    FROM (SELECT visit_time::DATE d, user_id, product_id, count(*) pv FROM v_visit GROUP BY ALL) v
    LEFT JOIN ({_FLAG.format(ts='fav_time', name='fav', table='v_fav')}) USING (d, user_id, product_id)
    LEFT JOIN ({_FLAG.format(ts='cart_time', name='cart', table='v_cart')}) USING (d, user_id, product_id)
    LEFT JOIN ({_FLAG.format(ts='order_time', name='ord', table='v_order')}) USING (d, user_id, product_id)
    LEFT JOIN (SELECT pay_time::DATE d, user_id, product_id, count(*) n, sum(pay_amount) a FROM v_pay GROUP BY ALL) y USING (d, user_id, product_id)
    LEFT JOIN (SELECT refund_time::DATE d, user_id, product_id, sum(refund_amount) a FROM v_refund GROUP BY ALL) r USING (d, user_id, product_id) GROUP BY v.d, v.user_id""")
def _(t):
    return days.user_day(*Product(t).all)


@query("product_daily_activity", f"""SELECT {_day('summary_date')}, activity_type, count(DISTINCT user_id) uv, {num('sum(order_amount)')} total_order_amount,
    {num('sum(coalesce(pay_amount,0))')} total_pay_amount, {num('sum(coalesce(refund_amount,0))')} total_refund_amount FROM order_money GROUP BY summary_date, activity_type""")
def _(t):
    return days.activity_day(*Product(t).money)


_TRADE = "total_order_amount", "total_pay_amount", "total_refund_amount"


@query("product_daily_trade", f"SELECT * REPLACE (strftime(summary_date,'%Y-%m-%d') AS summary_date, {_money(*_TRADE)}) FROM trade_1d")
def _(t):
    return days.trade_day(*Product(t).money)


_PCOLS = "product_id, product_name, category_id, category_name"


@query("product_report_day", f"""SELECT {_day('summary_date')}, {_PCOLS}, uv, pv, {num('avg_stay_seconds')} avg_stay_seconds, {num('bounce_rate')} bounce_rate, fav_users,
    cart_users, order_users, pay_users, {num('pay_amount')} pay_amount, {num('refund_amount')} refund_amount FROM product_1d""")
def _(t):
    return days.product_report_day(days.product_day(*Product(t).all))


_PROLL = f"""{big('sum(uv)')} uv, {big('sum(pv)')} pv, {half_up(cents('sum(avg_stay_seconds)'), '100*count(*)', 2)} avg_stay_seconds,
    {half_up('(sum(bounce_rate)*10000)::HUGEINT', '10000*count(*)', 4)} bounce_rate, {big('sum(fav_users)')} fav_users, {big('sum(cart_users)')} cart_users,
    {big('sum(order_users)')} order_users, {big('sum(pay_users)')} pay_users, {num('sum(pay_amount)')} pay_amount, {num('sum(refund_amount)')} refund_amount"""
_MONDAY = "strftime(date_trunc('week', summary_date),'%Y-%m-%d') week_monday"


@query("product_report_week", f"SELECT {_MONDAY}, strftime(min(summary_date),'%Y-%m-%d') week_start, {_PCOLS}, {_PROLL} FROM product_1d GROUP BY week_monday, {_PCOLS}")
def _(t):
    return days.product_report_week(days.product_day(*Product(t).all))


@query("product_report_month", f"SELECT strftime(summary_date,'%Y-%m') month_key, {_PCOLS}, {_PROLL} FROM product_1d GROUP BY month_key, {_PCOLS}")
def _(t):
    return days.product_report_month(days.product_day(*Product(t).all))


@query("trade_report_day", f"SELECT * REPLACE (strftime(summary_date,'%Y-%m-%d') AS summary_date, {_money(*_TRADE)}) FROM trade_1d")
def _(t):
    return days.trade_report_day(days.trade_day(*Product(t).money))


_TROLL = ", ".join([big(f"sum({c})") + f" {c}" for c in ("uv", "order_count", "pay_user_count")] + [num(f"sum({c})") + f" {c}" for c in _TRADE])


@query("trade_report_week", f"SELECT {_MONDAY}, strftime(min(summary_date),'%Y-%m-%d') week_start, {_TROLL} FROM trade_1d GROUP BY week_monday")
def _(t):
    return days.trade_report_week(days.trade_day(*Product(t).money))


@query("trade_report_month", f"SELECT strftime(summary_date,'%Y-%m') month_key, {_TROLL} FROM trade_1d GROUP BY month_key")
def _(t):
    return days.trade_report_month(days.trade_day(*Product(t).money))


# ---- product board -----------------------------------------------------------------------

def _pct_text(value: str) -> str:
    """Two-digit percent text of a double already rounded to two digits."""
    return f"(CASE WHEN {value} IS NOT NULL THEN printf('%.2f', {value})||'%' END)"


CTES.update({
    "b_product": "SELECT * REPLACE (CASE WHEN price_strength_star BETWEEN 1 AND 5 THEN price_strength_star ELSE 3 END AS price_strength_star) FROM board_product",
    "b_order": "SELECT *, pay_time::DATE dt FROM board_order WHERE pay_time IS NOT NULL",
    "b_traffic": "SELECT *, visit_time::DATE dt FROM board_traffic WHERE visitor_count>0",
    "b_sales": f"""SELECT o.*, p.category_id, p.product_name, '7d' stat_period FROM (SELECT product_id, sum(pay_amount) total_sales, sum(pay_quantity)::BIGINT total_quantity,
        sum(buyer_count)::BIGINT total_buyer_count FROM b_order WHERE dt <= {L_DAY} AND dt > {L_DAY}-7 GROUP BY 1) o JOIN b_product p USING (product_id)""",
    "b_sources": f"""SELECT t.*, {half_up('100*b.n', 'total_visitor', 2)} pay_conversion FROM (SELECT product_id, source, coalesce(search_word,'') search_word, dt,
        sum(visitor_count)::BIGINT total_visitor FROM b_traffic GROUP BY ALL) t LEFT JOIN (SELECT product_id, dt, sum(buyer_count) n FROM b_order GROUP BY ALL) b USING (product_id, dt)""",
    "b_flags": f"""SELECT p.product_id, p.s price_strength_star, CASE WHEN p.s<=2 THEN 1 ELSE 0 END::BIGINT is_price_warn,
        CASE WHEN b.m<5 THEN 1 ELSE 0 END::BIGINT is_product_warn FROM (SELECT product_id, max(price_strength_star) s FROM b_product GROUP BY 1) p
        LEFT JOIN (SELECT product_id, max(pay_conversion) m FROM b_sources WHERE dt={L_DAY} GROUP BY 1) b USING (product_id)""",
})


def traffic_days(t: Inputs):
    return board.traffic_totals(board.traffic_fact(t.board_traffic), board.order_fact(t.board_order))


def sales(t: Inputs):
    return board.sale_totals(board.order_fact(t.board_order), board.product_fact(t.board_product), log_day())


def flags(t: Inputs):
    return board.strength_flags(board.product_fact(t.board_product), traffic_days(t), log_day())


@query("board_fact_product", f"SELECT * REPLACE ({_money('coupon_price')}) FROM b_product")
def _(t):
    return board.product_fact(t.board_product)


@query("board_fact_order", f"SELECT * REPLACE (strftime(pay_time,'%Y-%m-%d %H:%M:%S') AS pay_time, strftime(dt,'%Y-%m-%d') AS dt, {_money('pay_amount')}) FROM b_order")
def _(t):
    return board.order_fact(t.board_order)


@query("board_fact_traffic", "SELECT * REPLACE (strftime(visit_time,'%Y-%m-%d %H:%M:%S') AS visit_time, strftime(dt,'%Y-%m-%d') AS dt) FROM b_traffic")
def _(t):
    return board.traffic_fact(t.board_traffic)


@query("board_fact_inventory", f"SELECT * REPLACE (strftime(update_time,'%Y-%m-%d %H:%M:%S') AS update_time), {_day('update_time', 'dt')} FROM board_inventory")
def _(t):
    return board.inventory_fact(t.board_inventory)


@query("board_sale_totals", f"SELECT * REPLACE ({_money('total_sales')}) FROM b_sales")
def _(t):
    return sales(t)


@query("board_traffic_totals", f"SELECT * REPLACE (strftime(dt,'%Y-%m-%d') AS dt), {_pct_text('pay_conversion')} pay_conversion_rate FROM b_sources")
def _(t):
    return traffic_days(t)


@query("board_strength_flags", "SELECT * FROM b_flags")
def _(t):
    return flags(t)


@query("board_product_ranking", """SELECT product_id, product_name, category_id, stat_period, rank() OVER (ORDER BY total_sales DESC) sales_rank,
    rank() OVER (ORDER BY total_quantity DESC) quantity_rank FROM b_sales""")
def _(t):
    return board.product_ranking(sales(t))


@query("board_top_sources", f"""SELECT source, total_visitor, {_pct_text('m')} pay_conversion_rate, row_number() OVER (ORDER BY total_visitor DESC, source) rank_num FROM (
    SELECT source, {big('sum(total_visitor)')} total_visitor, {half_up('(sum(pay_conversion::DECIMAL(18,2))*100)::HUGEINT', '100*count(pay_conversion)', 2)} m
    FROM b_sources WHERE dt={L_DAY} GROUP BY 1) QUALIFY rank_num<=10""")
def _(t):
    return board.top_sources(traffic_days(t), log_day())


@query("board_warnings", """SELECT product_id, '价格力预警' warn_type, price_strength_star FROM b_flags WHERE is_price_warn=1 UNION ALL
    SELECT product_id, '商品力预警', price_strength_star FROM b_flags WHERE is_product_warn=1""")
def _(t):
    return board.warnings(flags(t))


# ---- store entry -------------------------------------------------------------------------

for _terminal in ("pc", "wireless"):
    CTES[f"e_{_terminal}"] = f"""SELECT * FROM entry_log WHERE lower(terminal_type)='{_terminal}' AND page_id IS NOT NULL AND visitor_id IS NOT NULL AND is_order IN (0,1)
        QUALIFY row_number() OVER (PARTITION BY page_id, visitor_id, visit_time ORDER BY is_order DESC, page_type, data_date)=1"""
    CTES[f"e1_{_terminal}"] = f"""SELECT page_type, data_date stat_date, count(DISTINCT visitor_id) visitor_count, count(DISTINCT visitor_id) FILTER (is_order=1) order_buyer_count
        FROM e_{_terminal} GROUP BY 1,2"""
    CTES[f"ep_{_terminal}"] = f"""SELECT page_type, CASE recent_days WHEN 1 THEN 'day' WHEN 7 THEN '7day' ELSE '30day' END stat_period, '{log_day and L_DAY[6:-1]}' end_date,
        {big('sum(visitor_count)')} total_visitor_count, {big('sum(order_buyer_count)')} total_order_buyer_count FROM e1_{_terminal}, span3
        WHERE stat_date <= {L_DAY} AND stat_date > {L_DAY}-recent_days::INT GROUP BY 1,2"""
    CTES[f"s_{_terminal}"] = f"""SELECT *, (epoch_us(date_trunc('second', leave_time))-epoch_us(date_trunc('second', visit_time)))//1000000 stay_duration FROM shop_page_log
        WHERE terminal_type='{_terminal}' AND visitor_id IS NOT NULL AND leave_time>visit_time"""
    CTES[f"p_{_terminal}"] = f"SELECT *, jump_time::DATE jump_date FROM path_log WHERE terminal_type='{_terminal}'"
    CTES[f"pv_{_terminal}"] = f"""SELECT visitor_id, jump_date visit_date, page_id, visit_sequence, min(jump_time) visit_time, arg_min(page_type, (jump_time, page_type)) page_type FROM (
        SELECT visitor_id, jump_date, source_page_id page_id, source_page_type page_type, visit_sequence, jump_time FROM p_{_terminal} UNION ALL
        SELECT visitor_id, jump_date, target_page_id, target_page_type, visit_sequence, jump_time FROM p_{_terminal}) GROUP BY ALL"""


def _register_entry(term: str) -> None:
    @query(f"entry_fact_{term}", f"SELECT * REPLACE (strftime(visit_time,'%Y-%m-%d %H:%M:%S') AS visit_time, strftime(data_date,'%Y-%m-%d') AS data_date, is_order::BIGINT AS is_order) FROM e_{term}")
    def _(t):
        return entry.entry_fact(t.entry_log, term)

    @query(f"shop_page_fact_{term}", f"""SELECT * EXCLUDE (terminal_type) REPLACE (strftime(visit_time,'%Y-%m-%d %H:%M:%S') AS visit_time,
        strftime(leave_time,'%Y-%m-%d %H:%M:%S') AS leave_time, strftime(data_date,'%Y-%m-%d') AS data_date) FROM s_{term}""")
    def _(t):
        return entry.shop_page_fact(t.shop_page_log, term)

    @query(f"path_fact_{term}", f"""SELECT * EXCLUDE (terminal_type) REPLACE (strftime(jump_time,'%Y-%m-%d %H:%M:%S') AS jump_time, strftime(jump_date,'%Y-%m-%d') AS jump_date)
        FROM p_{term}""")
    def _(t):
        return entry.path_fact(t.path_log, term)

    @query(f"entry_daily_{term}", f"SELECT * REPLACE (strftime(stat_date,'%Y-%m-%d') AS stat_date) FROM e1_{term}")
    def _(t):
        return entry.entry_daily(entry.entry_fact(t.entry_log, term))

    @query(f"entry_periods_{term}", f"SELECT *, {half_up('total_order_buyer_count', 'total_visitor_count', 4)} conversion_rate FROM ep_{term}")
    def _(t):
        return entry.entry_periods(entry.entry_daily(entry.entry_fact(t.entry_log, term)), log_day())

    @query(f"entry_periods_distinct_{term}", f"""SELECT *, {half_up('total_order_buyer_count', 'total_visitor_count', 4)} conversion_rate FROM (SELECT page_type,
        CASE recent_days WHEN 1 THEN 'day' WHEN 7 THEN '7day' ELSE '30day' END stat_period, '{L_DAY[6:-1]}' end_date, count(DISTINCT visitor_id) total_visitor_count,
        count(DISTINCT visitor_id) FILTER (is_order=1) total_order_buyer_count FROM e_{term}, span3 WHERE data_date <= {L_DAY} AND data_date > {L_DAY}-recent_days::INT GROUP BY 1,2)""")
    def _(t):
        return entry.entry_periods_distinct(entry.entry_fact(t.entry_log, term), log_day())

    @query(f"entry_indicator_{term}", f"""SELECT page_type, CASE page_type WHEN '店铺页' THEN '包含首页、活动页、分类页、宝贝页、新品页等' WHEN '商品详情页' THEN '指商品的基础详情页面'
        ELSE '不属于前两类的兜底页面，如订阅页、直播页等' END page_type_desc, stat_period, end_date, visitor_count, order_buyer_count,
        {half_up('100*order_buyer_count', 'visitor_count', 2)} conversion_rate_pct FROM (SELECT CASE WHEN page_type IN ('首页','活动页','分类页','宝贝页','新品页') THEN '店铺页'
        WHEN page_type='商品详情页' THEN page_type ELSE '店铺其他页' END page_type, stat_period, end_date, {big('sum(total_visitor_count)')} visitor_count,
        {big('sum(total_order_buyer_count)')} order_buyer_count FROM ep_{term} GROUP BY 1,2,3)""")
    def _(t):
        return entry.entry_indicator(entry.entry_periods(entry.entry_daily(entry.entry_fact(t.entry_log, term)), log_day()))

    @query(f"shop_page_rank_{term}", f"""SELECT *, row_number() OVER (PARTITION BY data_date ORDER BY visit_count DESC, shop_page_subtype) visit_rank FROM (
        SELECT shop_page_subtype, {_day('data_date')}, count(DISTINCT visitor_id) visitor_count, count(*) visit_count,
        sum(stay_duration)::DOUBLE/count(*)::DOUBLE avg_stay_duration FROM s_{term} GROUP BY 1,2)""")
    def _(t):
        return entry.shop_page_rank(entry.shop_page_daily(entry.shop_page_fact(t.shop_page_log, term)))

    @query(f"shop_page_daily_{term}", f"""SELECT shop_page_subtype, {_day('data_date')}, count(DISTINCT visitor_id) visitor_count, count(*) visit_count,
        sum(stay_duration)::DOUBLE/count(*)::DOUBLE avg_stay_duration FROM s_{term} GROUP BY 1,2""")
    def _(t):
        return entry.shop_page_daily(entry.shop_page_fact(t.shop_page_log, term))

    @query(f"visitor_path_steps_{term}", f"""SELECT visitor_id, {_day('visit_date')}, row_number() OVER (PARTITION BY visitor_id, visit_date
        ORDER BY visit_time, visit_sequence, page_id, page_type) step, page_id, page_type, visit_sequence FROM pv_{term}""")
    def _(t):
        visits = paths.page_visits(entry.path_fact(t.path_log, term), F.col("jump_date"))
        return paths.path_steps(visits).select("visitor_id", "visit_date", "step", "page_id", "page_type", "visit_sequence")

    @query(f"visitor_paths_{term}", f"""SELECT visitor_id, {_day('visit_date')}, count(*)-1 path_length, first(page_id ORDER BY n) first_page_id, first(page_type ORDER BY n) first_page_type,
        last(page_id ORDER BY n) last_page_id, last(page_type ORDER BY n) last_page_type FROM (SELECT *, row_number() OVER (PARTITION BY visitor_id, visit_date
        ORDER BY visit_time, visit_sequence, page_id, page_type) n FROM pv_{term}) GROUP BY visitor_id, visit_date""")
    def _(t):
        return paths.path_ends(paths.path_steps(paths.page_visits(entry.path_fact(t.path_log, term), F.col("jump_date"))))

    @query(f"visitor_path_text_{term}", f"""SELECT visitor_id, {_day('visit_date')}, (n-1)//8 part, string_agg(coalesce(page_id::VARCHAR,'null'), '->' ORDER BY n) path
        FROM (SELECT *, row_number() OVER (PARTITION BY visitor_id, visit_date ORDER BY visit_time, visit_sequence, page_id, page_type) n FROM pv_{term})
        GROUP BY visitor_id, visit_date, (n-1)//8""")
    def _(t):
        visits = paths.page_visits(entry.path_fact(t.path_log, term), F.col("jump_date"))
        return paths.path_texts(paths.path_steps(visits), part_steps=8)

    @query(f"path_report_{term}", f"""SELECT source_page_type, target_page_type, {_day('jump_date', 'stat_date')}, n jump_count,
        {half_up('n', 'sum(n) OVER (PARTITION BY source_page_type, jump_date)', 4)} jump_rate,
        row_number() OVER (PARTITION BY jump_date ORDER BY n DESC, source_page_type, target_page_type) path_rank
        FROM (SELECT source_page_type, target_page_type, jump_date, count(*) n FROM p_{term} GROUP BY ALL)""")
    def _(t):
        return entry.path_report(entry.path_fact(t.path_log, term))


for _terminal in ("pc", "wireless"):
    _register_entry(_terminal)

CTES["entry_pages"] = "SELECT page_type source_page_type, data_date, count(DISTINCT visitor_id) visitor_count, count(*) visit_count FROM e_pc GROUP BY 1,2"


@query("entry_pages_pc", "SELECT * REPLACE (strftime(data_date,'%Y-%m-%d') AS data_date) FROM entry_pages")
def _(t):
    return entry.entry_pages(entry.entry_fact(t.entry_log, "pc"))


@query("top_entry_pages_pc", f"""SELECT * REPLACE (strftime(data_date,'%Y-%m-%d') AS data_date),
    {half_up('100*visitor_count', 'sum(visitor_count) OVER (PARTITION BY data_date)', 2)} visitor_ratio,
    {half_up('100*visit_count', 'sum(visit_count) OVER (PARTITION BY data_date)', 2)} visit_ratio,
    row_number() OVER (PARTITION BY data_date ORDER BY visitor_count DESC, visit_count DESC, source_page_type) top_rank FROM entry_pages QUALIFY top_rank<=20""")
def _(t):
    return entry.top_entry_pages(entry.entry_pages(entry.entry_fact(t.entry_log, "pc")))


# ---- page boards -------------------------------------------------------------------------

CTES.update({
    "beh": """SELECT id, user_id, session_id, coalesce(store_id,'UNKNOWN_STORE') store_id, item_id, CASE page_type WHEN '1' THEN 'home' WHEN '2' THEN 'item_list'
        WHEN '3' THEN 'item_detail' WHEN '4' THEN 'search_result' WHEN '5' THEN 'content' ELSE 'home' END page_type,
        CASE event_type WHEN '1' THEN 'view' WHEN '2' THEN 'search' WHEN '3' THEN 'add_to_cart' WHEN '4' THEN 'payment' WHEN '5' THEN 'payment_success' ELSE 'view' END event_type,
        event_time, search_rank, duration, coalesce(is_new_customer,0) is_new_customer, coalesce(repurchase_flag,0) repurchase_flag, acquisition_cost, coalesce(rating,3) rating,
        update_time, event_time::DATE dt FROM behaviour_log""",
    "pb_traffic": f"""SELECT dt, store_id, page_type, count(*) FILTER (event_type='view') page_views, count(DISTINCT user_id) FILTER (event_type='view') unique_visitors,
        coalesce({half_up("sum(duration) FILTER (event_type='view')", "count(*) FILTER (event_type='view')", 2)},0)::DECIMAL(16,2) avg_stay_duration,
        coalesce({half_up("100*count(*) FILTER (event_type='view' AND duration<10)", "count(*) FILTER (event_type='view')", 2)},0)::DECIMAL(16,2) bounce_rate,
        count(*) FILTER (event_type='search') search_count,
        coalesce({half_up("sum(search_rank) FILTER (event_type='search')", "count(search_rank) FILTER (event_type='search')", 2)},0)::DECIMAL(16,2) avg_search_rank FROM beh GROUP BY 1,2,3""",
    "pb_click": f"""SELECT dt, store_id, page_type, count(*) FILTER (event_type='view') click_count, count(DISTINCT user_id) FILTER (event_type='view') click_users,
        count(*) FILTER (event_type IN ('add_to_cart','payment')) conversion_clicks,
        coalesce({half_up("100*count(*) FILTER (event_type IN ('add_to_cart','payment'))", "count(*) FILTER (event_type='view')", 2)},0)::DECIMAL(16,2) conversion_rate FROM beh GROUP BY 1,2,3""",
})


def _guidance_sql(source: str, guided: str) -> str:
    return f"""SELECT dt, store_id, page_type, count(*) FILTER (event_type='view') page_views, count(*) FILTER ({guided}) to_item_detail_views,
        coalesce({half_up(f"100*count(*) FILTER ({guided})", "count(*) FILTER (event_type='view')", 2)},0)::DECIMAL(16,2) guidance_rate,
        count(DISTINCT user_id) FILTER (event_type='payment') payment_users, coalesce(sum(acquisition_cost) FILTER (event_type='payment'),0)::DECIMAL(16,2) payment_amount
        FROM {source} GROUP BY 1,2,3"""


CTES["beh_next"] = """SELECT *, CASE WHEN session_id<>'UNKNOWN_SESSION' THEN lead(page_type) OVER (PARTITION BY dt, session_id ORDER BY event_time, id, page_type) END nxt FROM beh"""
CTES["pb_guide"] = _guidance_sql("beh_next", "event_type='view' AND page_type<>'item_detail' AND nxt='item_detail'")
CTES["pb_scores"] = """SELECT dt, store_id, page_type,
    CASE WHEN page_views>0 OR unique_visitors>0 THEN round(least(page_views*0.03+unique_visitors*0.3+avg_stay_duration*2+(100-bounce_rate)*20, 100.0),2) ELSE 0 END::DECIMAL(5,2) traffic_score,
    CASE WHEN click_count>0 OR click_users>0 THEN round(least(click_count*0.4+click_users*0.6+conversion_clicks*3.0, 100.0),2) ELSE 0 END::DECIMAL(5,2) click_score,
    CASE WHEN guidance_rate>0 OR payment_users>0 THEN round(least(guidance_rate*0.4+payment_users*0.03+payment_amount*0.0003, 100.0),2) ELSE 0 END::DECIMAL(5,2) guidance_score
    FROM pb_traffic JOIN pb_click USING (dt, store_id, page_type) JOIN (SELECT * EXCLUDE (page_views) FROM pb_guide) USING (dt, store_id, page_type)"""
CTES["pb_overall"] = """SELECT *, CASE WHEN overall_score>=85 THEN 'A' WHEN overall_score>=70 THEN 'B' WHEN overall_score>=50 THEN 'C' ELSE 'D' END grade FROM (
    SELECT *, round(traffic_score*0.4+click_score*0.3+guidance_score*0.3,2)::DECIMAL(5,2) overall_score FROM pb_scores)"""


def behaviour(t: Inputs):
    return page_board.behaviour_fact(t.behaviour_log)


_DTR = "strftime(dt,'%Y-%m-%d') AS dt"


@query("behaviour_fact", f"SELECT * REPLACE ({_DTR}, strftime(event_time,'%Y-%m-%d %H:%M:%S') AS event_time, strftime(update_time,'%Y-%m-%d %H:%M:%S') AS update_time, {_money('acquisition_cost')}) FROM beh")
def _(t):
    return behaviour(t)


@query("behaviour_dim_product", """SELECT product_id::VARCHAR product_id, product_name, category_id::VARCHAR category_id, category_name, price::DOUBLE price FROM product_info""")
def _(t):
    return page_board.product_dim(t.product_info)


@query("behaviour_dim_store", f"""SELECT store_id, store_id store_name, store_id merchant_id, store_id merchant_name, substr(store_id,1,2) region, {_sec('min(event_time)', 'create_time')},
    {_sec('max(update_time)', 'update_time')} FROM behaviour_log WHERE store_id IS NOT NULL GROUP BY store_id""")
def _(t):
    return page_board.store_dim(t.behaviour_log)


@query("behaviour_dim_user", f"""SELECT user_id, user_id user_name, CASE WHEN n%10=0 THEN 'VIP会员' WHEN n%5=0 THEN '钻石会员' WHEN n%3=0 THEN '金牌会员' WHEN n%2=0 THEN '银牌会员' ELSE '普通会员' END user_level,
    {_sec('a', 'register_time')}, {_sec('b', 'last_login_time')}, CASE WHEN n%2=0 THEN '男' ELSE '女' END gender,
    CASE WHEN n%10<3 THEN '18-25岁' WHEN n%10<6 THEN '26-35岁' WHEN n%10<8 THEN '36-45岁' ELSE '46-55岁' END age_group
    FROM (SELECT user_id, user_id::BIGINT n, min(event_time) a, max(event_time) b FROM behaviour_log GROUP BY user_id)""")
def _(t):
    return page_board.user_dim(t.behaviour_log)


@query("page_traffic_daily", f"SELECT * REPLACE ({_DTR}, {_money('avg_stay_duration', 'bounce_rate', 'avg_search_rank')}) FROM pb_traffic")
def _(t):
    return page_board.page_traffic(behaviour(t))


@query("page_click_daily", f"SELECT * REPLACE ({_DTR}, {_money('conversion_rate')}) FROM pb_click")
def _(t):
    return page_board.page_clicks(behaviour(t))


@query("page_guidance_daily", f"SELECT * REPLACE ({_DTR}, {_money('guidance_rate', 'payment_amount')}) FROM pb_guide")
def _(t):
    return page_board.page_guidance(behaviour(t))


@query("page_guidance_daily_list_views", f"SELECT * REPLACE ({_DTR}, {_money('guidance_rate', 'payment_amount')}) FROM ({_guidance_sql('beh', chr(39).join(['event_type=', 'view', ' AND page_type=', 'item_list', '']))})")
def _(t):
    return page_board.page_guidance(behaviour(t), by_next_page=False)


def _boards(t: Inputs):
    fact = behaviour(t)
    return (page_board.traffic_board(page_board.page_traffic(fact)), page_board.click_board(page_board.page_clicks(fact)),
            page_board.guidance_board(page_board.page_guidance(fact)))


def _board_sql(table: str, score: str, money: tuple[str, ...]) -> str:
    return f"SELECT t.* REPLACE (strftime(t.dt,'%Y-%m-%d') AS dt, {', '.join(f't.{m}::DOUBLE AS {m}' for m in money)}), s.{score}::DOUBLE {score} FROM {table} t JOIN pb_scores s USING (dt, store_id, page_type)"


@query("page_traffic_board", _board_sql("pb_traffic", "traffic_score", ("avg_stay_duration", "bounce_rate", "avg_search_rank")))
def _(t):
    return _boards(t)[0]


@query("page_click_board", _board_sql("pb_click", "click_score", ("conversion_rate",)))
def _(t):
    return _boards(t)[1]


@query("page_guidance_board", _board_sql("pb_guide", "guidance_score", ("guidance_rate", "payment_amount")))
def _(t):
    return _boards(t)[2]


@query("page_overall_board", f"SELECT * REPLACE ({_DTR}, {_money('traffic_score', 'click_score', 'guidance_score', 'overall_score')}) FROM pb_overall")
def _(t):
    return page_board.overall_board(behaviour(t))


def _range(c):
    return f"count({c}) {c}_count, min({c})::DOUBLE {c}_min, sum({c})::DOUBLE/count({c})::DOUBLE {c}_avg, max({c})::DOUBLE {c}_max"


@query("page_score_summary", f"SELECT count(*) row_count, {_range('traffic_score')}, {_range('click_score')}, {_range('overall_score')} FROM pb_overall")
def _(t):
    return page_board.score_summary(page_board.overall_board(behaviour(t)))
