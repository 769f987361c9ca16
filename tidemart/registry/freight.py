"""Freight dimensions, facts, summaries and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..bridge.sql import CTES, big, num
from ..bridge.tables import Inputs, TRADE_DAY
from ..operators.joins import attach
from ..plans import freight_daily as daily, freight_dims as dims, freight_facts as facts, freight_reports as reports
from .base import query
from .retail import T_DAY, _day, _sec, trade_day

_STAGE_TEST = {
    "order": None, "pay": "status NOT IN ('60010','60999')", "cancel": "status='60999'",
    "receive": "status NOT IN ('60010','60020','60999')",
    "dispatch": "status NOT IN ('60010','60020','60030','60040','60999')",
    "bound_finish": "status NOT IN ('60010','60020','60030','60040','60050','60999')",
    "deliver": "status IN ('60070','60080')", "sign": "status='60080'",
}
_BILL_COLS = """w.order_no, w.status, w.collect_type, w.user_id, w.receiver_province_id, w.receiver_city_id, w.receiver_district_id,
    w.sender_province_id, w.sender_city_id, w.sender_district_id, w.payment_type, w.cargo_num, w.amount, w.distance,
    substr(w.receiver_name,1,1)||'*' receiver_name, substr(w.sender_name,1,1)||'*' sender_name, epoch_ms(w.estimate_arrive_time) estimate_arrive_time"""
for _name, _test in _STAGE_TEST.items():
    _time = "c.create_ts" if _test is None else "w.update_ts"
    CTES[f"bill_{_name}"] = f"""SELECT c.id, c.order_id, c.cargo_type, c.volume_length, c.volume_width, c.volume_height, c.weight, {_BILL_COLS},
        {_time} stage_time, {_time}::DATE dt FROM (SELECT * FROM cargo WHERE is_deleted='0') c {'LEFT' if _test is None else ''} JOIN
        (SELECT * FROM waybill WHERE is_deleted='0' AND {_test or 'true'}) w ON c.order_id=w.id"""


def _names_sql(time_col: str, source: str) -> str:
    return f"""SELECT b.* EXCLUDE (stage_time, dt) REPLACE (b.amount::DOUBLE AS amount, strftime(b.estimate_arrive_time,'%Y-%m-%d %H:%M:%S') AS estimate_arrive_time),
    {_sec('stage_time', time_col)}, {_day('dt')}, d1.name cargo_type_name, d2.name status_name, d3.name collect_type_name, d4.name payment_type_name
    FROM {source} b LEFT JOIN freight_dictionary d1 ON d1.id::VARCHAR=b.cargo_type LEFT JOIN freight_dictionary d2 ON d2.id::VARCHAR=b.status
    LEFT JOIN freight_dictionary d3 ON d3.id::VARCHAR=b.collect_type LEFT JOIN freight_dictionary d4 ON d4.id::VARCHAR=b.payment_type"""


CTES.update({
    "organ_live": "SELECT * FROM organ WHERE is_deleted='0'",
    "dim_shift": """SELECT s.*, l.name line_name, l.line_no, l.line_level, l.org_id, l.transport_line_type_id, l.distance, l.estimated_time,
        d.name transport_line_type_name FROM shift_base s JOIN line_base l ON s.line_id=l.id JOIN freight_dictionary d ON d.id=l.transport_line_type_id""",
    "dim_truck": """SELECT t.id, t.team_id, md5(t.truck_no) truck_no, t.truck_model_id, t.is_enabled, e.name team_name, e.team_no, e.org_id, e.manager_emp_id,
        m.model_name truck_model_name, m.model_type truck_model_type, m.brand truck_brand, m.load_weight, o.org_name, a.name truck_model_type_name,
        b.name truck_brand_name FROM truck_info t JOIN truck_team e ON e.id=t.team_id JOIN truck_model m ON m.id=t.truck_model_id
        JOIN organ_live o ON o.id=e.org_id JOIN freight_dictionary a ON a.id=m.model_type JOIN freight_dictionary b ON b.id=m.brand""",
    "finish": """SELECT t.id, shift_id, t.line_id, start_org_id, end_org_id, order_num, t.driver1_emp_id, substr(driver1_name,1,1)||'*' driver1_name,
        t.driver2_emp_id, substr(driver2_name,1,1)||'*' driver2_name, t.truck_id, md5(truck_no) truck_no, epoch_ms(actual_start_time) actual_start_time,
        epoch_ms(actual_end_time) actual_end_time, actual_distance, (actual_end_time-actual_start_time)//1000 finish_dur_sec,
        epoch_ms(actual_end_time)::DATE dt, epoch_ms(actual_start_time) + to_minutes(s.estimated_time::INT) estimate_end_time
        FROM transport_task t LEFT JOIN dim_shift s ON s.id=t.shift_id WHERE actual_end_time IS NOT NULL""",
    "org_orders": """SELECT o.id org_id, o.org_name, cargo_type, sender_city_id city_id, r.name city_name, d.name cargo_type_name, dt, count(order_id) order_count, sum(amt) order_amount
        FROM (SELECT order_id, cargo_type, sender_district_id, sender_city_id, dt, max(amount) amt FROM bill_order GROUP BY ALL) x
        LEFT JOIN organ_live o ON o.region_id=sender_district_id LEFT JOIN freight_region r ON r.id=sender_city_id
        LEFT JOIN freight_dictionary d ON d.id::VARCHAR=cargo_type GROUP BY ALL""",
    "station": """SELECT o.id org_id, o.org_name, o.region_id, c.id city_id, c.name city_name, p.id province_id, p.name province_name FROM organ_live o
        LEFT JOIN freight_region d ON d.id=o.region_id LEFT JOIN freight_region c ON c.id=d.parent_id LEFT JOIN freight_region p ON p.id=c.parent_id""",
    "org_recv": """SELECT org_id, org_name, city_id, city_name, province_id, province_name, dt, count(order_id) order_count, sum(amt) order_amount
        FROM (SELECT order_id, sender_district_id, dt, max(amount) amt FROM bill_receive GROUP BY ALL) x LEFT JOIN station s ON s.region_id=sender_district_id GROUP BY ALL""",
    "disp": "SELECT dt, count(order_id) order_count, sum(amt) order_amount FROM (SELECT order_id, dt, max(amount) amt FROM bill_dispatch GROUP BY ALL) GROUP BY ALL",
    "org_finish": """SELECT start_org_id org_id, o.org_name, truck_model_type, truck_model_type_name, dt, count(f.id) trans_finish_count,
        sum(actual_distance) trans_finish_distance, sum(finish_dur_sec) trans_finish_dur_sec FROM finish f LEFT JOIN organ_live o ON o.id=start_org_id
        LEFT JOIN dim_truck t ON t.id=f.truck_id GROUP BY ALL""",
    "org_deliv": """SELECT org_id, org_name, city_id, city_name, province_id, province_name, dt, count(order_id) order_count
        FROM (SELECT DISTINCT order_id, receiver_district_id, dt FROM bill_deliver) x LEFT JOIN station s ON s.region_id=receiver_district_id GROUP BY ALL""",
    "org_place": """SELECT o.id, o.org_name, CASE WHEN org_level=1 THEN a.id ELSE b.id END city_id, CASE WHEN org_level=1 THEN a.name ELSE b.name END city_name,
        CASE WHEN org_level=1 THEN b.id ELSE c.id END province_id, CASE WHEN org_level=1 THEN b.name ELSE c.name END province_name FROM organ_live o
        LEFT JOIN freight_region a ON a.id=o.region_id LEFT JOIN freight_region b ON b.id=a.parent_id LEFT JOIN freight_region c ON c.id=b.parent_id""",
    "org_sort": """SELECT b.org_id, p.org_name, p.city_id, p.city_name, p.province_id, p.province_name, epoch_ms(sort_time)::DATE dt, count(*) sort_count
        FROM org_bound b LEFT JOIN org_place p ON p.id=b.org_id WHERE sort_time IS NOT NULL GROUP BY ALL""",
    "shift_nd": f"""SELECT recent_days, f.shift_id, f.line_id, f.start_org_id org_id, f.driver1_emp_id, f.driver1_name, f.driver2_emp_id, f.driver2_name,
        p.org_name, p.city_id, p.city_name, s.line_name, t.truck_model_type, t.truck_model_type_name, f.truck_id, count(f.id) trans_finish_count,
        sum(actual_distance) trans_finish_distance, sum(finish_dur_sec) trans_finish_dur_sec, sum(order_num) trans_finish_order_count,
        count(*) FILTER (actual_end_time > estimate_end_time) trans_finish_delay_count FROM span2, finish f LEFT JOIN org_place p ON p.id=f.start_org_id
        LEFT JOIN dim_shift s ON s.id=f.shift_id LEFT JOIN dim_truck t ON t.id=f.truck_id WHERE dt <= {T_DAY} AND dt > {T_DAY}-recent_days::INT GROUP BY ALL""",
    "span2": "SELECT unnest([7,30])::BIGINT recent_days",
})


# ---- Spark side helpers ------------------------------------------------------------------

def organs(t: Inputs) -> DataFrame:
    return dims.live(t.organ)


def regions(t: Inputs) -> DataFrame:
    return dims.live(t.freight_region)


def core(t: Inputs, stage: str) -> DataFrame:
    return facts.waybill_core(t.cargo, t.waybill, facts.STAGES[stage])


def shifts(t: Inputs) -> DataFrame:
    return dims.shift_dim(t.shift_base, t.line_base, t.freight_dictionary)


def trucks(t: Inputs) -> DataFrame:
    return dims.truck_dim(t.truck_info, t.truck_team, t.truck_model, t.organ, t.freight_dictionary)


def finishes(t: Inputs) -> DataFrame:
    return facts.transport_finish_fact(t.transport_task, shifts(t))


def org_orders(t):
    return daily.org_cargo_orders(core(t, "order"), organs(t), regions(t), dims.live(t.freight_dictionary))


def org_receives(t):
    return daily.org_receives(core(t, "receive"), organs(t), regions(t))


def dispatched(t):
    return daily.dispatches(core(t, "dispatch"))


def org_finishes(t):
    return daily.org_truck_finishes(finishes(t), organs(t), trucks(t))


def org_deliveries(t):
    return daily.org_deliveries(core(t, "deliver"), organs(t), regions(t))


def org_sorts(t):
    return daily.org_sorts(facts.sort_fact(t.org_bound), organs(t), regions(t))


def shift_recent(t):
    return daily.shift_finishes_recent(finishes(t), organs(t), regions(t), shifts(t), trucks(t), trade_day())


# ---- dimensions --------------------------------------------------------------------------

@query("freight_dim_complex", """SELECT c.*, p.name province_name, y.name city_name, k.n courier_count FROM complex_base c
    JOIN freight_region p ON p.id=c.province_id JOIN freight_region y ON y.id=c.city_id
    LEFT JOIN (SELECT complex_id, count(DISTINCT courier_emp_id) n FROM courier_complex GROUP BY 1) k ON k.complex_id=c.id""")
def _(t):
    return dims.complex_dim(t.complex_base, t.freight_region, t.courier_complex)


@query("freight_dim_organ", """SELECT o.*, r.name region_name, r.dict_code region_code, p.org_name org_parent_name FROM organ_live o
    LEFT JOIN freight_region r ON r.id=o.region_id LEFT JOIN organ_live p ON p.id=o.org_parent_id""")
def _(t):
    return dims.organ_dim(t.organ, t.freight_region)


@query("freight_dim_region", "SELECT id, parent_id, name, dict_code FROM freight_region")
def _(t):
    return dims.region_dim(t.freight_region)


@query("freight_dim_courier", """SELECT c.* REPLACE (md5(working_phone) AS working_phone), o.org_name, d.name express_type_name FROM express_courier c
    JOIN organ_live o ON o.id=c.org_id JOIN freight_dictionary d ON d.id=c.express_type""")
def _(t):
    return dims.courier_dim(t.express_courier, t.organ, t.freight_dictionary)


@query("freight_dim_shift", "SELECT * FROM dim_shift")
def _(t):
    return shifts(t)


@query("freight_dim_driver", """SELECT d.*, o.org_name, e.name team_name FROM truck_driver d JOIN organ_live o ON o.id=d.org_id
    JOIN truck_team e ON e.id=d.team_id""")
def _(t):
    return dims.driver_dim(t.truck_driver, t.organ, t.truck_team)


@query("freight_dim_truck", "SELECT * FROM dim_truck")
def _(t):
    return trucks(t)


@query("freight_dim_user_zip", rf"""SELECT id, login_name, 'nick'||id nick_name, md5('pw'||id) passwd, md5(name) realname,
    CASE WHEN regexp_matches(phone_num, '^(13[0-9]|14[01456879]|15[0-35-9]|16[2567]|17[0-8]|18[0-9]|19[0-35-9])\d{{8}}$') THEN md5(phone_num) END phone_num,
    CASE WHEN regexp_matches(email, '^[a-zA-Z0-9_-]+@[a-zA-Z0-9_-]+(\.[a-zA-Z0-9_-]+)+$') THEN md5(email) END email, user_level,
    strftime(DATE '1970-01-01' + birthday::INT,'%Y-%m-%d') birthday, gender, {_day('create_time','start_date')}, '9999-12-31' end_date FROM user_info""")
def _(t):
    return dims.user_zip(t.freight_user)


@query("freight_dim_address_zip", rf"""SELECT id, user_id, CASE WHEN regexp_matches(phone, '^(13[0-9]|14[01456879]|15[0-35-9]|16[2567]|17[0-8]|18[0-9]|19[0-35-9])\d{{8}}$') THEN md5(phone) END phone, province_id, city_id,
    district_id, address, start_date, '9999-12-31' end_date FROM user_address""")
def _(t):
    return dims.address_zip(t.user_address)


# ---- facts -------------------------------------------------------------------------------

def _register_stage(stage: str, time_col: str) -> None:
    @query(f"freight_fact_{stage}", _names_sql(time_col, f"bill_{stage}"))
    def _(t):
        return facts.waybill_fact(t.cargo, t.waybill, t.freight_dictionary, facts.STAGES[stage])


for _name, _stage in facts.STAGES.items():
    _register_stage(_name, _stage.time_column)


CTES["bill_process"] = """SELECT b.*, b.dt start_date, CASE WHEN b.status IN ('60080','60999') THEN strftime(w.update_ts,'%Y-%m-%d')
    ELSE '9999-12-31' END end_date FROM bill_order b JOIN waybill w ON w.id=b.order_id AND w.is_deleted='0'"""


@query("freight_fact_process", f"SELECT * EXCLUDE (dt, start_date), strftime(start_date,'%Y-%m-%d') start_date FROM ({_names_sql('order_time', 'bill_process')})")
def _(t):
    return facts.waybill_process(t.cargo, t.waybill, t.freight_dictionary)


@query("freight_fact_transport_finish", f"""SELECT f.* REPLACE (strftime(actual_start_time,'%Y-%m-%d %H:%M:%S') AS actual_start_time,
    strftime(actual_end_time,'%Y-%m-%d %H:%M:%S') AS actual_end_time, strftime(dt,'%Y-%m-%d') AS dt, strftime(estimate_end_time,'%Y-%m-%d %H:%M:%S') AS estimate_end_time,
    actual_distance::DOUBLE AS actual_distance), o.org_name start_org_name FROM finish f LEFT JOIN organ_live o ON o.id=f.start_org_id""")
def _(t):
    return facts.transport_finish_fact(t.transport_task, shifts(t), organs(t))


def _bound_sql(time: str, emp: str) -> str:
    return f"""SELECT id, order_id, org_id, strftime(epoch_ms({time}),'%Y-%m-%d %H:%M:%S') {time}, {emp}, strftime(epoch_ms({time}),'%Y-%m-%d') dt
        FROM org_bound WHERE {time} IS NOT NULL"""


@query("freight_fact_inbound", _bound_sql("inbound_time", "inbound_emp_id"))
def _(t):
    return facts.inbound_fact(t.org_bound)


@query("freight_fact_sort", _bound_sql("sort_time", "sorter_emp_id"))
def _(t):
    return facts.sort_fact(t.org_bound)


@query("freight_fact_outbound", _bound_sql("outbound_time", "outbound_emp_id"))
def _(t):
    return facts.outbound_fact(t.org_bound)


# ---- summaries ---------------------------------------------------------------------------

_OA = f"order_count::BIGINT AS order_count, order_amount::DOUBLE AS order_amount"
_FD = "trans_finish_count::BIGINT AS trans_finish_count, trans_finish_distance::DOUBLE AS trans_finish_distance, trans_finish_dur_sec::BIGINT AS trans_finish_dur_sec"
_DTR = "strftime(dt,'%Y-%m-%d') AS dt"
_OSUM = f"{big('sum(order_count)')} order_count, {num('sum(order_amount)')} order_amount"
_SPANW = f"WHERE dt <= {T_DAY} AND dt > {T_DAY}-recent_days::INT"
_PLACE = ", ".join(daily.PLACE)


@query("freight_daily_org_cargo_order", f"SELECT * REPLACE ({_OA}, {_DTR}) FROM org_orders")
def _(t):
    return org_orders(t)


@query("freight_daily_org_receive", f"SELECT * REPLACE ({_OA}, {_DTR}) FROM org_recv")
def _(t):
    return org_receives(t)


@query("freight_daily_dispatch", f"SELECT * REPLACE ({_OA}, {_DTR}) FROM disp")
def _(t):
    return dispatched(t)


@query("freight_daily_org_truck_finish", f"SELECT * REPLACE ({_FD}, {_DTR}) FROM org_finish")
def _(t):
    return org_finishes(t)


@query("freight_daily_org_deliver", f"SELECT * REPLACE ({_DTR}) FROM org_deliv")
def _(t):
    return org_deliveries(t)


@query("freight_daily_org_sort", f"SELECT * REPLACE ({_DTR}) FROM org_sort")
def _(t):
    return org_sorts(t)


@query("freight_recent_org_cargo_order", f"""SELECT org_id, org_name, city_id, city_name, cargo_type, cargo_type_name, recent_days, {_OSUM}
    FROM org_orders, span2 {_SPANW} GROUP BY ALL""")
def _(t):
    return daily.org_cargo_orders_recent(org_orders(t), trade_day())


@query("freight_recent_org_receive", f"SELECT {_PLACE}, recent_days, {_OSUM} FROM org_recv, span2 {_SPANW} GROUP BY ALL")
def _(t):
    return daily.org_receives_recent(org_receives(t), trade_day())


@query("freight_recent_dispatch", f"SELECT recent_days, {_OSUM} FROM disp, span2 {_SPANW} GROUP BY ALL")
def _(t):
    return daily.dispatches_recent(dispatched(t), trade_day())


_SHIFT_COLS = """SELECT * EXCLUDE (truck_id) REPLACE (trans_finish_distance::DOUBLE AS trans_finish_distance, trans_finish_dur_sec::BIGINT AS trans_finish_dur_sec,
    trans_finish_order_count::BIGINT AS trans_finish_order_count) FROM shift_nd"""


@query("freight_recent_shift_finish", _SHIFT_COLS)
def _(t):
    return shift_recent(t)


@query("freight_recent_org_deliver", f"SELECT {_PLACE}, recent_days, {big('sum(order_count)')} order_count FROM org_deliv, span2 {_SPANW} GROUP BY ALL")
def _(t):
    return daily.org_deliveries_recent(org_deliveries(t), trade_day())


@query("freight_recent_org_sort", f"SELECT {_PLACE}, recent_days, {big('sum(sort_count)')} sort_count FROM org_sort, span2 {_SPANW} GROUP BY ALL")
def _(t):
    return daily.org_sorts_recent(org_sorts(t), trade_day())


@query("freight_todate_dispatch", f"SELECT {_OSUM} FROM disp")
def _(t):
    return daily.dispatches_to_date(dispatched(t))


CTES["bound_td"] = "SELECT count(*) order_count, sum(a) order_amount FROM (SELECT order_id, max(amount) a FROM bill_bound_finish GROUP BY 1)"


@query("freight_todate_bound_finish", "SELECT order_count, order_amount::DOUBLE order_amount FROM bound_td")
def _(t):
    return daily.bound_finishes_to_date(core(t, "bound_finish"))


# ---- reports -----------------------------------------------------------------------------

_D = f"'{TRADE_DAY}' dt"


@query("freight_report_waybill_stats", f"""SELECT {_D}, recent_days, receive_order_count, receive_order_amount, dispatch_order_count, dispatch_order_amount FROM
    (SELECT recent_days, {big('sum(order_count)')} receive_order_count, {num('sum(order_amount)')} receive_order_amount FROM org_recv, span3 {_SPANW} GROUP BY 1) a
    FULL JOIN (SELECT recent_days, {big('sum(order_count)')} dispatch_order_count, {num('sum(order_amount)')} dispatch_order_amount FROM disp, span3 {_SPANW} GROUP BY 1) b USING (recent_days)""")
def _(t):
    return reports.waybill_stats(org_receives(t), dispatched(t), trade_day())


_FSUM = f"{big('sum(trans_finish_count)')} trans_finish_count, {num('sum(trans_finish_distance)')} trans_finish_distance, {big('sum(trans_finish_dur_sec)')} trans_finish_dur_sec"
_FAVG = "sum(trans_finish_distance)::DOUBLE/sum(trans_finish_count)::DOUBLE avg_trans_finish_distance, sum(trans_finish_dur_sec)::DOUBLE/sum(trans_finish_count)::DOUBLE avg_trans_finish_dur_sec"


@query("freight_report_transport_stats", f"SELECT {_D}, recent_days, {_FSUM} FROM org_finish, span3 {_SPANW} GROUP BY recent_days")
def _(t):
    return reports.transport_stats(org_finishes(t), trade_day())


@query("freight_report_on_the_way", f"""SELECT {_D}, {big('(SELECT sum(order_count) FROM disp) - (SELECT order_count FROM bound_td)')} bounding_order_count,
    {num('(SELECT sum(order_amount) FROM disp) - (SELECT order_amount FROM bound_td)')} bounding_order_amount""")
def _(t):
    return reports.waybills_on_the_way(daily.dispatches_to_date(dispatched(t)),
                                       daily.bound_finishes_to_date(core(t, "bound_finish")), trade_day())


@query("freight_report_order_stats", f"SELECT {_D}, recent_days, {_OSUM} FROM org_orders, span3 {_SPANW} GROUP BY recent_days")
def _(t):
    return reports.order_stats(org_orders(t), trade_day())


@query("freight_report_cargo_type_stats", f"SELECT {_D}, recent_days, cargo_type, cargo_type_name, {_OSUM} FROM org_orders, span3 {_SPANW} GROUP BY ALL")
def _(t):
    return reports.cargo_type_stats(org_orders(t), trade_day())


def _place_sql(keys: list[str], finish_from: str) -> str:
    k = ", ".join(keys)
    on = " AND ".join(f"a.{c} IS NOT DISTINCT FROM b.{c}" for c in [*keys, "recent_days"])
    out = ", ".join(f"coalesce(a.{c}, b.{c}) {c}" for c in [*keys, "recent_days"])
    return f"""SELECT {_D}, {out}, order_count, order_amount, trans_finish_count, trans_finish_distance, trans_finish_dur_sec, avg_trans_finish_distance,
        avg_trans_finish_dur_sec FROM (SELECT {k}, recent_days, {_OSUM} FROM org_orders, span3 {_SPANW} GROUP BY ALL) a
        FULL JOIN (SELECT {k}, recent_days, {_FSUM}, {_FAVG} FROM {finish_from}, span3 {_SPANW} GROUP BY ALL) b ON {on}"""


CTES["city_finish"] = "SELECT f.* EXCLUDE (org_name), p.org_name, p.city_id, p.city_name FROM org_finish f LEFT JOIN org_place p ON p.id=f.org_id"


@query("freight_report_city_stats", _place_sql(["city_id", "city_name"], "city_finish"))
def _(t):
    located = attach(org_finishes(t), daily.org_places(organs(t), regions(t)), "org_id", "id", ["city_id", "city_name"])
    return reports.place_stats(org_orders(t), located, ["city_id", "city_name"], trade_day())


@query("freight_report_org_stats", _place_sql(["org_id", "org_name"], "org_finish"))
def _(t):
    return reports.place_stats(org_orders(t), org_finishes(t), ["org_id", "org_name"], trade_day())


_SSUM = f"{_FSUM}, {big('sum(trans_finish_order_count)')} trans_finish_order_count"


@query("freight_report_shift_stats", f"SELECT {_D}, recent_days, shift_id, {_SSUM} FROM shift_nd GROUP BY ALL")
def _(t):
    return reports.shift_stats(shift_recent(t), trade_day())


@query("freight_report_line_stats", f"SELECT {_D}, recent_days, line_id, line_name, {_SSUM} FROM shift_nd GROUP BY ALL")
def _(t):
    return reports.line_stats(shift_recent(t), trade_day())


@query("freight_report_driver_stats", f"""WITH h AS (SELECT recent_days, driver1_emp_id e, driver1_name n, driver2_emp_id IS NOT NULL two, * FROM shift_nd UNION ALL
    SELECT recent_days, driver2_emp_id, driver2_name, true, * FROM shift_nd WHERE driver2_emp_id IS NOT NULL),
    g AS (SELECT recent_days, e driver_emp_id, n driver_name, sum(trans_finish_count) c, sum(trans_finish_distance*(CASE WHEN two THEN 0.5 ELSE 1.0 END)) d,
    sum(trans_finish_dur_sec::DECIMAL(20,0)*(CASE WHEN two THEN 0.5 ELSE 1.0 END)) s, sum(trans_finish_delay_count) l FROM h GROUP BY 1,2,3)
    SELECT {_D}, recent_days, driver_emp_id, driver_name, c::BIGINT trans_finish_count, d::DOUBLE trans_finish_distance, s::DOUBLE trans_finish_dur_sec,
    d::DOUBLE/c::DOUBLE avg_trans_finish_distance, s::DOUBLE/c::DOUBLE avg_trans_finish_dur_sec, l::BIGINT trans_finish_late_count FROM g""")
def _(t):
    return reports.driver_stats(shift_recent(t), trade_day())


@query("freight_report_truck_stats", f"SELECT {_D}, recent_days, truck_model_type, truck_model_type_name, {_FSUM}, {_FAVG} FROM shift_nd GROUP BY ALL")
def _(t):
    return reports.truck_stats(shift_recent(t), trade_day())


def _express_sql(keys: list[str]) -> str:
    parts = [("org_recv", {"receive_order_count": big("sum(order_count)"), "receive_order_amount": num("sum(order_amount)")}),
             ("org_deliv", {"deliver_suc_count": big("sum(order_count)")}), ("org_sort", {"sort_count": big("sum(sort_count)")})]
    metrics = [m for _, p in parts for m in p]
    sel = []
    for table, own in parts:
        cols = ", ".join(f"{own.get(m, 'NULL')} {m}" for m in metrics)
        sel.append(f"SELECT {', '.join([*keys, 'recent_days'])}, {cols} FROM {table}, span3 {_SPANW} GROUP BY {', '.join([*keys, 'recent_days'])}")
    return (f"SELECT {_D}, {', '.join([*keys, 'recent_days'])}, {', '.join(f'max({m}) {m}' for m in metrics)} FROM ("
            + " UNION ALL ".join(sel) + f") GROUP BY {', '.join([*keys, 'recent_days'])}")


def _register_express(name: str, keys: list[str]) -> None:
    @query(name, _express_sql(keys))
    def _(t):
        return reports.express_stats(org_receives(t), org_deliveries(t), org_sorts(t), keys, trade_day())


_register_express("freight_report_express_totals", [])
_register_express("freight_report_express_by_province", ["province_id", "province_name"])
_register_express("freight_report_express_by_city", ["city_id", "city_name"])
_register_express("freight_report_express_by_org", ["org_id", "org_name"])
