"""The same input tables as SQL text, for the reference queries.

`with_inputs(query)` puts in front of a query the definitions of the tables it
names, and of the tables those need.
"""

from __future__ import annotations

import re

CTES: dict[str, str] = {
    "lines": """SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) detail_id, l_orderkey, l_partkey,
        l_suppkey, l_linenumber::BIGINT l_linenumber, l_quantity::BIGINT qty, l_extendedprice::DECIMAL(16,2) price,
        round(l_discount*100)::BIGINT disc, round(l_tax*100)::BIGINT tax, l_returnflag, l_linestatus, l_shipdate ship
        FROM lineitem""",
    "heads": """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice::DECIMAL(16,2) total, o_orderdate ordered,
        o_orderpriority FROM orders""",
    "ev": """SELECT event_id, ts, user_id, event_type, value::DECIMAL(16,2) val, (props->>'$.k')::BIGINT k FROM events""",
    # retail dimensions
    "sku_info": """SELECT p_partkey id, p_retailprice::DECIMAL(16,2) price, p_name sku_name, p_size::BIGINT weight,
        concat_ws('/', p_brand, p_size) spu_id, p_brand tm_id FROM part""",
    "spu_info": """SELECT DISTINCT concat_ws('/', p_brand, p_size) id, 'spu '||p_brand||' '||p_size spu_name,
        p_size::BIGINT category3_id FROM part""",
    "category3": "SELECT DISTINCT p_size::BIGINT id, 'c3-'||p_size AS name, p_size::BIGINT%10+1 category2_id FROM part",
    "category2": """SELECT DISTINCT p_size::BIGINT%10+1 id, 'c2-'||(p_size%10+1) AS name,
        (p_size::BIGINT%10+1)%3+1 category1_id FROM part""",
    "category1": "SELECT DISTINCT (p_size::BIGINT%10+1)%3+1 id, 'c1-'||((p_size%10+1)%3+1) AS name FROM part",
    "trademark": "SELECT DISTINCT p_brand id, lower(p_brand) tm_name FROM part",
    "sku_attr": "SELECT p_partkey*10 id, p_partkey sku_id, 'type' attr_name, p_type value_name FROM part",
    "sku_sale_attr": """SELECT p_partkey*10+1 id, p_partkey sku_id, 'colour' sale_attr_name,
        split_part(p_name,' ',1) sale_attr_value_name FROM part""",
    "dictionary": """SELECT prefix||(r_regionkey+1) dic_code, kind||' '||lower(r_name) dic_name, parent parent_code
        FROM region, (VALUES ('11','110','pay'),('31','310','activity'),('32','320','coupon'),('33','330','range'),
        ('12','120','appraise'),('15','150','refund'),('13','130','reason')) v(parent,prefix,kind)""",
    "coupon_info": """SELECT n_nationkey::BIGINT id, 'coupon '||n_name coupon_name, '320'||(n_nationkey%4+1) coupon_type,
        n_nationkey::BIGINT*100+100 condition_amount, n_nationkey::BIGINT%5+1 condition_num, n_nationkey::BIGINT+5 benefit_amount,
        n_nationkey::BIGINT%9+1 benefit_discount, '330'||(n_nationkey%3+1) range_type FROM nation""",
    "activity_info": "SELECT r_regionkey::BIGINT id, 'activity '||r_name activity_name FROM region",
    "activity_rule": """SELECT n_nationkey::BIGINT id, n_nationkey::BIGINT%6 activity_id, '310'||(n_nationkey%4+1) activity_type,
        n_nationkey::BIGINT*10 condition_amount, n_nationkey::BIGINT%4+1 condition_num, n_nationkey::BIGINT+1 benefit_amount,
        n_nationkey::BIGINT%9+1 benefit_discount, n_nationkey::BIGINT%3+1 benefit_level FROM nation""",
    "province": """SELECT n_nationkey::BIGINT id, n_name AS name, lpad(n_nationkey::VARCHAR,6,'1') area_code,
        'CN-'||n_nationkey iso_code, 'CN-X'||n_nationkey iso_3166_2, n_regionkey::BIGINT region_id FROM nation""",
    "area": "SELECT r_regionkey::BIGINT id, r_name region_name FROM region",
    "promotion_pos": "SELECT n_nationkey::BIGINT id, n_name pos_location, 'banner' pos_type, 'sku' promotion_type FROM nation",
    "promotion_refer": "SELECT r_regionkey::BIGINT id, r_name refer_name FROM region",
    "user_info": """SELECT c_custkey id, c_name AS name, 'u'||c_custkey login_name,
        CASE WHEN c_custkey%10=0 THEN 'bad-number' ELSE '13'||lpad((c_custkey*7919%1000000000)::VARCHAR,9,'0') END phone_num,
        CASE WHEN c_custkey%7=0 THEN 'no mail' ELSE 'user'||c_custkey||'@mail.com' END email, c_mktsegment user_level,
        c_custkey*37%20000 birthday, CASE WHEN c_custkey%3=0 THEN NULL WHEN c_custkey%2=0 THEN 'F' ELSE 'M' END gender,
        TIMESTAMP '2024-01-01' + to_hours((c_custkey%30*24 + c_custkey%24)::INT) create_time FROM customer""",
    # retail facts
    "order_head": """SELECT o_orderkey id, o_custkey user_id,
        CASE o_orderstatus WHEN 'F' THEN '1004' WHEN 'P' THEN '1003' ELSE '1001' END order_status, total total_amount,
        (o_orderkey%50)::DECIMAL(16,2) activity_reduce_amount, (o_orderkey%7)::DECIMAL(16,2) coupon_reduce_amount,
        ordered create_time FROM heads""",
    "order_info": "SELECT h.*, c_nationkey::BIGINT province_id FROM order_head h LEFT JOIN customer ON c_custkey=h.user_id",
    "order_detail": """SELECT *, (sku_num*order_price - coalesce(split_activity_amount,0) - coalesce(split_coupon_amount,0))::DECIMAL(16,2)
        split_total_amount FROM (SELECT detail_id id, l_orderkey order_id, l_partkey sku_id, qty sku_num, price order_price,
        CASE WHEN l_returnflag<>'N' THEN tax::DECIMAL(16,2) END split_activity_amount,
        CASE WHEN disc>0 THEN disc::DECIMAL(16,2) END split_coupon_amount, ship create_time FROM lines)""",
    "order_detail_activity": """SELECT detail_id order_detail_id, l_suppkey%6 activity_id, l_suppkey%25 activity_rule_id
        FROM lines WHERE l_returnflag='R'""",
    "order_detail_coupon": "SELECT detail_id order_detail_id, l_partkey%25 coupon_id FROM lines WHERE disc>=6",
    "payment_info": """SELECT o_orderkey id, o_orderkey order_id, o_custkey user_id, '110'||substr(o_orderpriority,1,1) payment_type,
        CASE WHEN o_orderstatus='F' THEN '1602' ELSE '1601' END payment_status, total total_amount,
        ordered + to_hours((o_orderkey%72)::INT) callback_time FROM heads WHERE o_orderstatus<>'O'""",
    "order_status_log": """SELECT o_orderkey order_id, CASE WHEN o_orderstatus='F' THEN '1004' ELSE '1001' END order_status,
        ordered + to_hours((o_orderkey%24+168)::INT) create_time FROM heads""",
    "cart_info": """SELECT event_id id, user_id, k sku_id, 'sku-'||k sku_name, event_id%3+1 sku_num, ts create_time,
        event_id%2 is_ordered FROM ev WHERE event_type='signup'""",
    "favor_info": """SELECT event_id id, user_id, k sku_id, ts create_time, CASE WHEN event_id%5=0 THEN '1' ELSE '0' END is_cancel
        FROM ev WHERE event_type='click'""",
    "coupon_use": """SELECT event_id id, k%25 coupon_id, user_id, event_id order_id, CASE WHEN event_id%3<>0 THEN ts END used_time
        FROM ev WHERE event_type='purchase'""",
    # page log, already flattened
    "log_all": """SELECT *, (event_type='view' AND k%10=0) is_start, (event_type='error' AND k=13) broken,
        (user_id%25)::VARCHAR ar, ['Apple','TCL','Xiaomi','Huawei'][(user_id%4+1)::INT] ba, 'ch'||(k%5) ch,
        (event_id%2)::VARCHAR is_new, ['Apple','TCL','Xiaomi','Huawei'][(user_id%4+1)::INT]||'-'||(user_id%3) md,
        'mid_'||user_id mid, CASE WHEN user_id%2=0 THEN 'iOS 17.1' ELSE 'Android 14' END os,
        user_id||'_'||strftime(ts,'%Y%m%d') sid, CASE WHEN user_id%17<>0 THEN user_id::VARCHAR END uid, 'v'||(event_id%3) vc,
        k::VARCHAR item, CASE WHEN event_type='click' AND k%4=0 THEN 'keyword' ELSE 'sku_id' END item_type,
        CASE event_type WHEN 'view' THEN 'home' WHEN 'click' THEN 'good_detail' WHEN 'signup' THEN 'cart'
        WHEN 'purchase' THEN 'trade' ELSE 'payment' END page_id, (val*1000)::BIGINT during_time, epoch_us(ts)//1000 ms,
        date_trunc('millisecond', ts) view_ts, ts::DATE dt FROM ev""",
    "page_view": "SELECT * FROM log_all WHERE NOT broken AND NOT is_start",
    # product domain
    "product_info": """SELECT p_partkey product_id, p_name product_name, p_size::BIGINT category_id, p_type category_name,
        p_retailprice::DECIMAL(16,2) price FROM part""",
    "product_visit": """SELECT event_id visit_id, k product_id, user_id, ts visit_time, floor(val)::BIGINT stay_seconds,
        CASE WHEN user_id%2=0 THEN 'PC' ELSE 'MOBILE' END terminal_type, event_id%2 is_micro_detail
        FROM ev WHERE event_type IN ('view','click')""",
    "product_favorite": "SELECT event_id fav_id, k product_id, user_id, ts fav_time FROM ev WHERE event_type='click'",
    "product_cart": "SELECT event_id cart_id, k product_id, user_id, event_id%3+1 quantity, ts cart_time FROM ev WHERE event_type='signup'",
    "product_order": """SELECT event_id order_id, k product_id, user_id, event_id%4+1 quantity, val order_amount, ts order_time,
        CASE WHEN k%3=0 THEN 'JUHUASUAN' ELSE 'NONE' END activity_type FROM ev WHERE event_type='purchase'""",
    "product_payment": """SELECT event_id payment_id, event_id order_id, k product_id, user_id,
        CASE WHEN event_id%11=0 THEN 0::DECIMAL(16,2) ELSE val END pay_amount, ts + to_minutes((event_id%90-1)::INT) pay_time,
        CASE WHEN k%3=0 THEN 'JUHUASUAN' ELSE 'NONE' END activity_type FROM ev WHERE event_type='purchase' AND event_id%4<>0""",
    "product_refund": """SELECT event_id refund_id, event_id order_id, k product_id, user_id, val refund_amount, ts refund_time
        FROM ev WHERE event_type='purchase' AND event_id%5=0""",
    # ranking domain
    "board_product": """SELECT p_partkey product_id, p_size::BIGINT category_id, p_name product_name, p_size::BIGINT%8 price_strength_star,
        p_retailprice::DECIMAL(16,2) coupon_price FROM part""",
    "board_order": """SELECT event_id order_id, k product_id, user_id, val pay_amount, CASE WHEN event_id%13<>0 THEN ts END pay_time,
        event_id%3+1 buyer_count, event_id%5+1 pay_quantity FROM ev WHERE event_type='purchase'""",
    "board_traffic": """SELECT event_id traffic_id, k product_id, event_id%6 visitor_count, event_type||'-'||(user_id%6) source,
        CASE WHEN event_id%2=0 THEN 'word'||(event_id%4) END search_word, ts visit_time FROM ev WHERE event_type<>'purchase'""",
    "board_inventory": """SELECT p_partkey inventory_id, p_partkey sku_id, p_size::BIGINT*10 current_stock, p_size::BIGINT%30 saleable_days,
        TIMESTAMP '2024-01-01' + to_hours((p_partkey%30*24+5)::INT) update_time FROM part""",
    # entry and path logs
    "entry_log": """SELECT 'p'||k page_id, ['首页','活动页','分类页','宝贝页','新品页','商品详情页','订阅页','直播页'][(k%8+1)::INT] page_type,
        CASE WHEN event_id%97<>0 THEN user_id::VARCHAR END visitor_id, date_trunc('hour', ts) visit_time,
        CASE WHEN event_type='purchase' THEN 1 WHEN event_type='error' AND k=5 THEN 2 ELSE 0 END is_order, ts::DATE data_date,
        CASE WHEN user_id%2=0 THEN 'PC' ELSE 'Wireless' END terminal_type FROM ev""",
    "shop_page_log": """SELECT 's'||k shop_page_id, 'subtype-'||(k%12) shop_page_subtype,
        CASE WHEN event_id%97<>0 THEN user_id::VARCHAR END visitor_id, ts visit_time, ts + to_seconds(floor(val)::INT) leave_time,
        ts::DATE data_date, CASE WHEN user_id%2=0 THEN 'pc' ELSE 'wireless' END terminal_type FROM ev""",
    "path_log": """SELECT event_id::VARCHAR path_record_id, user_id::VARCHAR visitor_id, 'p'||k source_page_id, event_type source_page_type,
        'p'||(k*7%100) target_page_id, ['view','click','purchase'][(k%3+1)::INT] target_page_type, ts jump_time,
        hour(ts)*60+minute(ts) visit_sequence, CASE WHEN user_id%2=0 THEN 'pc' ELSE 'wireless' END terminal_type FROM ev""",
    "behaviour_log": """SELECT event_id id, user_id::VARCHAR user_id, user_id||'_'||strftime(ts,'%Y%m%d') session_id,
        CASE WHEN k<>99 THEN 'S'||(k%10) END store_id, k::VARCHAR item_id, (k%6)::VARCHAR page_type,
        CASE event_type WHEN 'view' THEN '1' WHEN 'click' THEN '2' WHEN 'signup' THEN '3' WHEN 'purchase' THEN '4' ELSE 'view' END event_type,
        ts event_time, CASE WHEN event_type='click' THEN k%50 END search_rank, floor(val)::BIGINT duration,
        CASE WHEN k%4<>0 THEN event_id%2 END is_new_customer, NULL::BIGINT repurchase_flag, val acquisition_cost,
        CASE WHEN event_id%9<>0 THEN event_id%5+1 END rating, ts update_time FROM ev""",
    # freight
    "freight_region": """SELECT *, 'R'||id dict_code FROM (
        SELECT (r_regionkey+100)::BIGINT id, 86::BIGINT parent_id, 'P-'||r_name AS name FROM region UNION ALL
        SELECT (n_nationkey+1000)::BIGINT, (n_regionkey+100)::BIGINT, 'C-'||n_name FROM nation UNION ALL
        SELECT s_suppkey+10000, s_suppkey%25+1000, 'D-'||s_suppkey FROM supplier)""",
    "organ": """SELECT s_suppkey id, s_name org_name, CASE WHEN s_suppkey%5=0 THEN 1 ELSE 2 END::BIGINT org_level,
        CASE WHEN s_suppkey%5=0 THEN s_suppkey%25+1000 ELSE s_suppkey+10000 END region_id, s_suppkey - s_suppkey%5 org_parent_id,
        CASE WHEN s_suppkey%40=39 THEN '1' ELSE '0' END is_deleted FROM supplier""",
    "freight_dictionary": """SELECT CASE WHEN n_nationkey=8 THEN 60999 ELSE n_nationkey::BIGINT*10+60010 END id, 'status '||n_nationkey AS name
        FROM nation WHERE n_nationkey<9 UNION ALL
        SELECT n_nationkey::BIGINT+base, kind||' '||n_nationkey FROM nation, (VALUES (61001,'cargo',6),(62001,'collect',2),
        (63001,'payment',3),(64001,'express',2),(65001,'truck',3),(66001,'line',3)) v(base,kind,lim) WHERE n_nationkey<lim""",
    "waybill": """SELECT o_orderkey id, 'YD'||o_orderkey order_no,
        (CASE WHEN o_orderkey%9=8 THEN 60999 ELSE o_orderkey%9*10+60010 END)::VARCHAR status, (o_orderkey%2+62001)::VARCHAR collect_type,
        o_custkey user_id, o_custkey%100+10000 sender_district_id, o_custkey%100%25+1000 sender_city_id,
        o_custkey%100%25%5+100 sender_province_id, o_orderkey%100+10000 receiver_district_id, o_orderkey%100%25+1000 receiver_city_id,
        o_orderkey%100%25%5+100 receiver_province_id, 'R'||o_orderkey receiver_name, 'S'||o_custkey sender_name,
        (o_orderkey%3+63001)::VARCHAR payment_type, o_orderkey%3+1 cargo_num, total amount, epoch_ms(ordered)+259200000 estimate_arrive_time,
        o_orderkey%1000 distance, ordered + to_hours((o_orderkey%48)::INT) update_ts,
        CASE WHEN o_orderkey%50=0 THEN '1' ELSE '0' END is_deleted FROM heads""",
    "cargo": """SELECT detail_id id, l_orderkey order_id, (l_linenumber%7+61001)::VARCHAR cargo_type, qty volume_length, qty%7 volume_width,
        qty%5 volume_height, qty*2 weight, ship + to_hours(l_linenumber::INT) create_ts,
        CASE WHEN l_linenumber=7 AND l_returnflag='N' THEN '1' ELSE '0' END is_deleted FROM lines""",
    "transport_task": """SELECT detail_id id, l_partkey%25 shift_id, l_partkey%25%10 line_id, l_suppkey start_org_id, l_partkey%100 end_org_id,
        qty order_num, l_partkey%200 driver1_emp_id, 'D'||(l_partkey%200) driver1_name,
        CASE WHEN l_linenumber%2=1 THEN l_partkey%100+200 END driver2_emp_id,
        'E'||CASE WHEN l_linenumber%2=1 THEN l_partkey%100+200 END driver2_name, l_suppkey%25 truck_id, 'TN'||(l_suppkey%25) truck_no,
        epoch_ms(ship)+l_linenumber*3600000 actual_start_time,
        CASE WHEN l_linestatus<>'O' OR l_returnflag<>'N' THEN epoch_ms(ship)+l_linenumber*3600000+qty*900000 END actual_end_time,
        price actual_distance FROM lines""",
    "shift_base": """SELECT n_nationkey::BIGINT id, n_nationkey::BIGINT%10 line_id, '08:00:00' start_time, n_nationkey::BIGINT+1 driver1_emp_id,
        n_nationkey::BIGINT+200 driver2_emp_id, n_nationkey::BIGINT truck_id FROM nation""",
    "line_base": """SELECT n_nationkey::BIGINT id, 'line-'||n_nationkey AS name, 'L'||n_nationkey line_no, n_nationkey::BIGINT%2+1 line_level,
        n_nationkey::BIGINT*5 org_id, n_nationkey::BIGINT%3+66001 transport_line_type_id, n_nationkey::BIGINT*40+60 estimated_time,
        n_nationkey::BIGINT*100 distance FROM nation WHERE n_nationkey<10""",
    "truck_model": """SELECT r_regionkey::BIGINT id, 'model '||r_name model_name, r_regionkey::BIGINT%3+65001 model_type,
        r_regionkey::BIGINT%3+65001 brand, r_regionkey::BIGINT*5+5 load_weight FROM region""",
    "truck_team": """SELECT r_regionkey::BIGINT id, 'team '||r_name AS name, 'T'||r_regionkey team_no, r_regionkey::BIGINT org_id,
        r_regionkey::BIGINT+500 manager_emp_id FROM region""",
    "truck_info": """SELECT n_nationkey::BIGINT id, n_nationkey::BIGINT%5 team_id, 'TN'||n_nationkey truck_no,
        n_nationkey::BIGINT%5 truck_model_id, n_nationkey::BIGINT%2 is_enabled FROM nation""",
    "truck_driver": """SELECT s_suppkey id, s_suppkey+1 emp_id, s_suppkey org_id, s_suppkey%6 team_id, 'B2' license_type,
        'LN'||s_suppkey license_no, s_suppkey%2 is_enabled FROM supplier""",
    "express_courier": """SELECT s_suppkey id, s_suppkey+1000 emp_id, s_suppkey org_id, '139'||lpad(s_suppkey::VARCHAR,8,'0') working_phone,
        s_suppkey%3+64001 express_type FROM supplier""",
    "courier_complex": "SELECT s_suppkey+1000 courier_emp_id, s_suppkey//3 complex_id FROM supplier",
    "complex_base": """SELECT s_suppkey id, 'complex '||s_suppkey complex_name, s_suppkey%25%5+100 province_id, s_suppkey%25+1000 city_id,
        s_suppkey+10000 district_id, 'D-'||s_suppkey district_name FROM supplier""",
    "org_bound": """SELECT detail_id id, l_orderkey order_id, l_suppkey org_id, epoch_ms(ship) inbound_time, l_partkey%50 inbound_emp_id,
        CASE WHEN l_returnflag<>'N' THEN epoch_ms(ship)+7200000 END sort_time, l_partkey%60 sorter_emp_id,
        CASE WHEN l_linestatus<>'O' THEN epoch_ms(ship)+14400000 END outbound_time, l_partkey%70 outbound_emp_id FROM lines""",
    "user_address": """SELECT c_custkey+1 id, c_custkey user_id,
        CASE WHEN c_custkey%9=0 THEN 'none' ELSE '152'||lpad(c_custkey::VARCHAR,8,'0') END phone, c_custkey%25%5+100 province_id,
        c_custkey%25+1000 city_id, c_custkey%100+10000 district_id, 'road '||c_custkey address,
        strftime(DATE '2024-01-01' + (c_custkey%30)::INT,'%Y-%m-%d')||' 01:02:03' start_date FROM customer""",
}

_WORD = re.compile(r"[a-z_][a-z0-9_]*")


def _needed(text: str, seen: list[str], own: frozenset[str] = frozenset()) -> None:
    for name in dict.fromkeys(_WORD.findall(re.sub(r"'[^']*'", "''", text))):
        if name in CTES and name not in seen and name not in own:
            _needed(CTES[name], seen)
            if name not in seen:
                seen.append(name)


def with_inputs(query: str) -> str:
    """Complete SQL text of a query over the input tables."""
    query = query.strip()
    names: list[str] = []
    _needed(query, names)
    if not names:
        return query
    head = ",\n".join(f"{n} AS ({CTES[n]})" for n in names)
    if query[:5].upper() == "WITH ":
        return f"WITH {head},\n{query[5:]}"
    return f"WITH {head}\n{query}"


def half_up(num: str, den: str, digits: int) -> str:
    """num / den rounded half up with whole-number arithmetic (both whole, num >= 0)."""
    scale = 10 ** digits
    return (f"(((2*({num})::HUGEINT*{scale} + ({den})) // (2*nullif(({den})::HUGEINT,0)))::DOUBLE / {scale}.0)")


def cents(amount: str) -> str:
    return f"(({amount})*100)::HUGEINT"


def num(expr: str) -> str:
    return f"({expr})::DOUBLE"


def big(expr: str) -> str:
    return f"({expr})::BIGINT"
