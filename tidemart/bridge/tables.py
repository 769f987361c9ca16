"""Input tables of every domain as views over the benchmark tables.

`Inputs(spark, folder)` gives each input table as a lazy DataFrame; all rows of the
underlying table are kept, and Catalyst prunes the columns a job does not use.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import schemas
from ..session import scratch_path, tuned
from ..sources.versions import Folder

TRADE_DAY = "2001-07-31"
LOG_DAY = "2024-01-30"


def money(col) -> Column:
    return F.col(col).cast("decimal(16,2)") if isinstance(col, str) else col.cast("decimal(16,2)")


def text(col) -> Column:
    return F.col(col).cast("string") if isinstance(col, str) else col.cast("string")


def _choice(number: Column, *values: str) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (number % len(values) + 1).cast("int"))


def _plus_hours(ts: Column, hours: Column) -> Column:
    return F.timestamp_seconds(F.unix_seconds(ts) + hours * 3600)


class Inputs:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = tuned(spark), folder.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def raw_stream(self, name: str) -> DataFrame:
        stream = self.spark.readStream.schema(self.raw(name).schema)
        if Folder(self.spark, self.folder).is_folder(f"{name}.parquet"):   # a filter on names sees the files in it only
            return stream.parquet(f"{self.folder}/{name}.parquet")
        return stream.option("pathGlobFilter", f"{name}.parquet").parquet(self.folder)

    def batches(self, name: str, order: str, least: int = 4, most_rows: int = 5_000_000) -> DataFrame:
        """The table as a stream of micro-batches: ranges of `order`, in that order, each unsorted.

        All rows come, the files of a range per batch; NULL goes with the first range. A file has
        about `most_rows` rows at most, and there are more than `least` ranges only beyond 16 of those per range.
        """
        table = self.raw(name)
        rows = table.count()
        parts = max(least, -(-rows // (16 * most_rows)))
        rank = F.col(order)
        if "timestamp" in table.schema[order].dataType.simpleString():
            rank = rank.cast("timestamp")
        rank = rank.cast("double")
        cuts = table.select(F.percentile_approx(rank, [k / parts for k in range(1, parts)], 1000)).first()[0] or []
        place = F.lit(0)
        for cut in cuts:
            place = place + F.coalesce((rank > cut).cast("int"), F.lit(0))
        return self._in_turn(f"{name}-batches", [table.filter(place == k) for k in range(parts)], rows, min(most_rows, self.FILE_ROWS))

    def even_batches(self, name: str, key: str, n: int = 4) -> DataFrame:
        """The table as `n` micro-batches: equal spans of the whole-number column `key`, in that order. Each row has the
        number of its batch as `place`; NULL goes with the first. An empty span is an empty batch."""
        table = self.raw(name)
        low, high, rows = table.agg(F.min(key), F.max(key), F.count(F.lit(1))).first()
        place = F.lit(0) if low is None else F.coalesce(F.expr(f"cast(({key} - {low}) * {n} div ({high} - {low} + 1) as int)"), F.lit(0))
        placed = table.withColumn("place", place)
        return self._in_turn(f"{name}-even", [placed.filter(F.col("place") == k) for k in range(n)], rows, self.FILE_ROWS)

    #: Rows of a file of a micro-batch. Its files are read side by side, and a file's rows become several messages each.
    FILE_ROWS = 100_000

    def _in_turn(self, name: str, parts: list[DataFrame], rows: int, file_rows: int) -> DataFrame:
        """A stream with a micro-batch for each of `parts` (of `rows` rows in all), in that order.

        The source takes files by age and a fixed number at a time, so each part gets the same number of
        files: a job writes none for a partition without rows, and empty files make up for those.
        """
        path = scratch_path(self.spark, name)
        files = max(1, -(-rows // (len(parts) * file_rows)))
        nothing = self.spark.createDataFrame([], parts[0].schema).coalesce(1)
        for k, part in enumerate(parts):
            part.repartition(files).write.mode("append").parquet(path)
            for _ in range((k + 1) * files - sum(n.endswith(".parquet") for n in Folder(self.spark, path).names())):
                nothing.write.mode("append").parquet(path)
        return self.spark.readStream.schema(parts[0].schema).option("maxFilesPerTrigger", files).parquet(path)

    # ---- base tables with plain types -------------------------------------------------

    @cached_property
    def lines(self) -> DataFrame:
        return self.shape_lines(self.raw("lineitem"))

    @staticmethod
    def shape_lines(df: DataFrame) -> DataFrame:
        return df.select(
            F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("detail_id"),
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
            F.col("l_quantity").cast("bigint").alias("qty"),
            money("l_extendedprice").alias("price"),
            F.round(F.col("l_discount") * 100).cast("bigint").alias("disc"),
            F.round(F.col("l_tax") * 100).cast("bigint").alias("tax"),
            "l_returnflag", "l_linestatus", F.col("l_shipdate").cast("timestamp").alias("ship"))

    @cached_property
    def heads(self) -> DataFrame:
        return self.shape_heads(self.raw("orders"))

    @staticmethod
    def shape_heads(df: DataFrame) -> DataFrame:
        return df.select("o_orderkey", "o_custkey", "o_orderstatus",
                         money("o_totalprice").alias("total"),
                         F.col("o_orderdate").cast("timestamp").alias("ordered"),
                         "o_orderpriority")

    @cached_property
    def events(self) -> DataFrame:
        return self.shape_events(self.raw("events"))

    @staticmethod
    def shape_events(df: DataFrame) -> DataFrame:
        return df.select(
            "event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type",
            money("value").alias("val"),
            F.get_json_object("props", "$.k").cast("bigint").alias("k"))

    # ---- retail: dimensions --------------------------------------------------------

    @cached_property
    def sku_info(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("id"), money("p_retailprice").alias("price"),
            F.col("p_name").alias("sku_name"), F.col("p_size").cast("bigint").alias("weight"),
            F.concat_ws("/", "p_brand", "p_size").alias("spu_id"), F.col("p_brand").alias("tm_id"))

    @cached_property
    def spu_info(self) -> DataFrame:
        return self.raw("part").select(
            F.concat_ws("/", "p_brand", "p_size").alias("id"),
            F.concat(F.lit("spu "), "p_brand", F.lit(" "), "p_size").alias("spu_name"),
            F.col("p_size").cast("bigint").alias("category3_id")).distinct()

    @cached_property
    def category3(self) -> DataFrame:
        size = F.col("p_size").cast("bigint")
        return self.raw("part").select(
            size.alias("id"), F.concat(F.lit("c3-"), size).alias("name"),
            (size % 10 + 1).alias("category2_id")).distinct()

    @cached_property
    def category2(self) -> DataFrame:
        c2 = F.col("p_size").cast("bigint") % 10 + 1
        return self.raw("part").select(
            c2.alias("id"), F.concat(F.lit("c2-"), c2).alias("name"),
            (c2 % 3 + 1).alias("category1_id")).distinct()

    @cached_property
    def category1(self) -> DataFrame:
        c1 = (F.col("p_size").cast("bigint") % 10 + 1) % 3 + 1
        return self.raw("part").select(
            c1.alias("id"), F.concat(F.lit("c1-"), c1).alias("name")).distinct()

    @cached_property
    def trademark(self) -> DataFrame:
        return self.raw("part").select(F.col("p_brand").alias("id"),
                                       F.lower("p_brand").alias("tm_name")).distinct()

    @cached_property
    def sku_attr(self) -> DataFrame:
        return self.raw("part").select(
            (F.col("p_partkey") * 10).alias("id"), F.col("p_partkey").alias("sku_id"),
            F.lit("type").alias("attr_name"), F.col("p_type").alias("value_name"))

    @cached_property
    def sku_sale_attr(self) -> DataFrame:
        return self.raw("part").select(
            (F.col("p_partkey") * 10 + 1).alias("id"), F.col("p_partkey").alias("sku_id"),
            F.lit("colour").alias("sale_attr_name"),
            F.element_at(F.split("p_name", " "), 1).alias("sale_attr_value_name"))

    @cached_property
    def dictionary(self) -> DataFrame:
        region = self.raw("region")
        code = F.col("r_regionkey") + 1
        kinds = [("11", "110", "pay"), ("31", "310", "activity"), ("32", "320", "coupon"),
                 ("33", "330", "range"), ("12", "120", "appraise"), ("15", "150", "refund"),
                 ("13", "130", "reason")]
        rows = F.array(*[F.struct(
            F.concat(F.lit(prefix), code).alias("dic_code"),
            F.concat(F.lit(name + " "), F.lower("r_name")).alias("dic_name"),
            F.lit(parent).alias("parent_code")) for parent, prefix, name in kinds])
        return region.select(F.inline(rows))

    @cached_property
    def coupon_info(self) -> DataFrame:
        n = F.col("n_nationkey").cast("bigint")
        return self.raw("nation").select(
            n.alias("id"), F.concat(F.lit("coupon "), "n_name").alias("coupon_name"),
            F.concat(F.lit("320"), n % 4 + 1).alias("coupon_type"),
            (n * 100 + 100).alias("condition_amount"), (n % 5 + 1).alias("condition_num"),
            (n + 5).alias("benefit_amount"), (n % 9 + 1).alias("benefit_discount"),
            F.concat(F.lit("330"), n % 3 + 1).alias("range_type"))

    @cached_property
    def activity_info(self) -> DataFrame:
        return self.raw("region").select(
            F.col("r_regionkey").cast("bigint").alias("id"),
            F.concat(F.lit("activity "), "r_name").alias("activity_name"))

    @cached_property
    def activity_rule(self) -> DataFrame:
        n = F.col("n_nationkey").cast("bigint")
        return self.raw("nation").select(
            n.alias("id"), (n % 6).alias("activity_id"),
            F.concat(F.lit("310"), n % 4 + 1).alias("activity_type"),
            (n * 10).alias("condition_amount"), (n % 4 + 1).alias("condition_num"),
            (n + 1).alias("benefit_amount"), (n % 9 + 1).alias("benefit_discount"),
            (n % 3 + 1).alias("benefit_level"))

    @cached_property
    def province(self) -> DataFrame:
        n = F.col("n_nationkey").cast("bigint")
        return self.raw("nation").select(
            n.alias("id"), F.col("n_name").alias("name"),
            F.lpad(n.cast("string"), 6, "1").alias("area_code"),
            F.concat(F.lit("CN-"), n).alias("iso_code"),
            F.concat(F.lit("CN-X"), n).alias("iso_3166_2"),
            F.col("n_regionkey").cast("bigint").alias("region_id"))

    @cached_property
    def region(self) -> DataFrame:
        return self.raw("region").select(F.col("r_regionkey").cast("bigint").alias("id"),
                                         F.col("r_name").alias("region_name"))

    @cached_property
    def promotion_pos(self) -> DataFrame:
        return self.raw("nation").select(
            F.col("n_nationkey").cast("bigint").alias("id"), F.col("n_name").alias("pos_location"),
            F.lit("banner").alias("pos_type"), F.lit("sku").alias("promotion_type"))

    @cached_property
    def promotion_refer(self) -> DataFrame:
        return self.raw("region").select(
            F.col("r_regionkey").cast("bigint").alias("id"), F.col("r_name").alias("refer_name"))

    @cached_property
    def user_info(self) -> DataFrame:
        return self.shape_users(self.raw("customer"))

    @staticmethod
    def shape_users(df: DataFrame) -> DataFrame:
        key = F.col("c_custkey")
        opened = F.lit("2024-01-01 00:00:00").cast("timestamp")
        return df.select(
            key.alias("id"), F.col("c_name").alias("name"),
            F.concat(F.lit("u"), key).alias("login_name"),
            F.when(key % 10 == 0, "bad-number").otherwise(
                F.concat(F.lit("13"), F.lpad((key * 7919 % 1000000000).cast("string"), 9, "0")))
            .alias("phone_num"),
            F.when(key % 7 == 0, "no mail").otherwise(
                F.concat(F.lit("user"), key, F.lit("@mail.com"))).alias("email"),
            F.col("c_mktsegment").alias("user_level"),
            (key * 37 % 20000).alias("birthday"),
            F.when(key % 3 == 0, F.lit(None)).when(key % 2 == 0, "F").otherwise("M").alias("gender"),
            _plus_hours(opened, key % 30 * 24 + key % 24).alias("create_time"))

    # ---- retail: facts -----------------------------------------------------------------

    @cached_property
    def order_head(self) -> DataFrame:
        """Orders without the province, which needs the customer table."""
        return self.heads.select(
            F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("user_id"),
            F.when(F.col("o_orderstatus") == "F", "1004")
            .when(F.col("o_orderstatus") == "P", "1003").otherwise("1001").alias("order_status"),
            F.col("total").alias("total_amount"),
            money(F.col("o_orderkey") % 50).alias("activity_reduce_amount"),
            money(F.col("o_orderkey") % 7).alias("coupon_reduce_amount"),
            F.col("ordered").alias("create_time"))

    @cached_property
    def order_info(self) -> DataFrame:
        cust = self.raw("customer").select(F.col("c_custkey").alias("user_id"),
                                           F.col("c_nationkey").cast("bigint").alias("province_id"))
        return self.order_head.join(cust, "user_id", "left")

    @cached_property
    def order_detail(self) -> DataFrame:
        original = F.col("qty") * F.col("price")
        act = F.when(F.col("l_returnflag") != "N", money(F.col("tax")))
        cou = F.when(F.col("disc") > 0, money(F.col("disc")))
        return self.lines.select(
            F.col("detail_id").alias("id"), F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("sku_id"), F.col("qty").alias("sku_num"),
            F.col("price").alias("order_price"), act.alias("split_activity_amount"),
            cou.alias("split_coupon_amount"),
            (original - F.coalesce(act, F.lit(0)) - F.coalesce(cou, F.lit(0)))
            .cast("decimal(16,2)").alias("split_total_amount"),
            F.col("ship").alias("create_time"))

    @cached_property
    def order_detail_activity(self) -> DataFrame:
        return self.lines.filter(F.col("l_returnflag") == "R").select(
            F.col("detail_id").alias("order_detail_id"), (F.col("l_suppkey") % 6).alias("activity_id"),
            (F.col("l_suppkey") % 25).alias("activity_rule_id"))

    @cached_property
    def order_detail_coupon(self) -> DataFrame:
        return self.lines.filter(F.col("disc") >= 6).select(
            F.col("detail_id").alias("order_detail_id"), (F.col("l_partkey") % 25).alias("coupon_id"))

    @cached_property
    def payment_info(self) -> DataFrame:
        return self.heads.filter(F.col("o_orderstatus") != "O").select(
            F.col("o_orderkey").alias("id"), F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("user_id"),
            F.concat(F.lit("110"), F.substring("o_orderpriority", 1, 1)).alias("payment_type"),
            F.when(F.col("o_orderstatus") == "F", "1602").otherwise("1601").alias("payment_status"),
            F.col("total").alias("total_amount"),
            _plus_hours(F.col("ordered"), F.col("o_orderkey") % 72).alias("callback_time"))

    @cached_property
    def order_status_log(self) -> DataFrame:
        return self.heads.select(
            F.col("o_orderkey").alias("order_id"),
            F.when(F.col("o_orderstatus") == "F", "1004").otherwise("1001").alias("order_status"),
            _plus_hours(F.col("ordered"), F.col("o_orderkey") % 24 + 168).alias("create_time"))

    @cached_property
    def cart_info(self) -> DataFrame:
        return self.events.filter(F.col("event_type") == "signup").select(
            F.col("event_id").alias("id"), "user_id", F.col("k").alias("sku_id"),
            F.concat(F.lit("sku-"), "k").alias("sku_name"), (F.col("event_id") % 3 + 1).alias("sku_num"),
            F.col("ts").alias("create_time"), (F.col("event_id") % 2).alias("is_ordered"))

    @cached_property
    def favor_info(self) -> DataFrame:
        return self.events.filter(F.col("event_type") == "click").select(
            F.col("event_id").alias("id"), "user_id", F.col("k").alias("sku_id"),
            F.col("ts").alias("create_time"),
            F.when(F.col("event_id") % 5 == 0, "1").otherwise("0").alias("is_cancel"))

    @cached_property
    def coupon_use(self) -> DataFrame:
        return self.events.filter(F.col("event_type") == "purchase").select(
            F.col("event_id").alias("id"), (F.col("k") % 25).alias("coupon_id"), "user_id",
            F.col("event_id").alias("order_id"),
            F.when(F.col("event_id") % 3 != 0, F.col("ts")).alias("used_time"))

    # ---- page log -------------------------------------------------------------------------

    @cached_property
    def raw_log(self) -> DataFrame:
        return self.shape_log(self.events)

    @staticmethod
    def shape_log(events: DataFrame) -> DataFrame:
        """One JSON text per event; some are start records, some are broken."""
        uid, eid, k = F.col("user_id"), F.col("event_id"), F.col("k")
        is_start = (F.col("event_type") == "view") & (k % 10 == 0)
        brand = _choice(uid, "Apple", "TCL", "Xiaomi", "Huawei")
        common = F.struct(
            text(uid % 25).alias("ar"), brand.alias("ba"), F.concat(F.lit("ch"), k % 5).alias("ch"),
            text(eid % 2).alias("is_new"), F.concat_ws("-", brand, text(uid % 3)).alias("md"),
            F.concat(F.lit("mid_"), uid).alias("mid"),
            F.when(uid % 2 == 0, "iOS 17.1").otherwise("Android 14").alias("os"),
            F.concat_ws("_", text(uid), F.date_format("ts", "yyyyMMdd")).alias("sid"),
            F.when(uid % 17 != 0, text(uid)).alias("uid"), F.concat(F.lit("v"), eid % 3).alias("vc"))
        page = F.struct(
            text(k).alias("item"),
            F.when((F.col("event_type") == "click") & (k % 4 == 0), "keyword").otherwise("sku_id")
            .alias("item_type"),
            F.when(F.col("event_type") == "view", "home").when(F.col("event_type") == "click", "good_detail")
            .when(F.col("event_type") == "signup", "cart").when(F.col("event_type") == "purchase", "trade")
            .otherwise("payment").alias("page_id"),
            (F.col("val") * 1000).cast("bigint").alias("during_time"))
        display = lambda i: F.create_map(
            F.lit("item"), text(k + i), F.lit("pos_id"), text(F.lit(i)))
        displays = F.slice(F.array(display(1), display(2)), 1, (k % 3).cast("int"))
        action = F.create_map(F.lit("action_id"), F.lit("favor_add"), F.lit("item"), text(k))
        record = F.struct(
            common.alias("common"),
            F.when(~is_start, page).alias("page"),
            F.when(~is_start & (k % 3 > 0), displays).alias("displays"),
            F.when(~is_start & (k % 2 == 1), F.array(action)).alias("actions"),
            F.when(is_start, F.create_map(F.lit("entry"), F.lit("icon"), F.lit("open_ad_id"), text(k)))
            .alias("start"),
            F.when(F.col("event_type") == "error", F.create_map(F.lit("error_code"), text(k)))
            .alias("err"),
            F.unix_millis("ts").alias("ts"))
        broken = (F.col("event_type") == "error") & (k == 13)
        return events.select(
            F.when(broken, F.concat(F.lit('{"common": broken '), eid)).otherwise(F.to_json(record))
            .alias("log"), F.to_date("ts").alias("dt"))

    # ---- product domain -------------------------------------------------------------------

    @cached_property
    def product_info(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
            F.col("p_size").cast("bigint").alias("category_id"), F.col("p_type").alias("category_name"),
            money("p_retailprice").alias("price"))

    @cached_property
    def product_visit(self) -> DataFrame:
        return self.events.filter(F.col("event_type").isin("view", "click")).select(
            F.col("event_id").alias("visit_id"), F.col("k").alias("product_id"), "user_id",
            F.col("ts").alias("visit_time"), F.floor("val").cast("bigint").alias("stay_seconds"),
            F.when(F.col("user_id") % 2 == 0, "PC").otherwise("MOBILE").alias("terminal_type"),
            (F.col("event_id") % 2).alias("is_micro_detail"))

    @cached_property
    def product_favorite(self) -> DataFrame:
        return self.events.filter(F.col("event_type") == "click").select(
            F.col("event_id").alias("fav_id"), F.col("k").alias("product_id"), "user_id",
            F.col("ts").alias("fav_time"))

    @cached_property
    def product_cart(self) -> DataFrame:
        return self.events.filter(F.col("event_type") == "signup").select(
            F.col("event_id").alias("cart_id"), F.col("k").alias("product_id"), "user_id",
            (F.col("event_id") % 3 + 1).alias("quantity"), F.col("ts").alias("cart_time"))

    @cached_property
    def product_order(self) -> DataFrame:
        return self.events.filter(F.col("event_type") == "purchase").select(
            F.col("event_id").alias("order_id"), F.col("k").alias("product_id"), "user_id",
            (F.col("event_id") % 4 + 1).alias("quantity"), F.col("val").alias("order_amount"),
            F.col("ts").alias("order_time"),
            F.when(F.col("k") % 3 == 0, "JUHUASUAN").otherwise("NONE").alias("activity_type"))

    @cached_property
    def product_payment(self) -> DataFrame:
        minutes = F.col("event_id") % 90 - 1
        return self.events.filter((F.col("event_type") == "purchase") & (F.col("event_id") % 4 != 0)).select(
            F.col("event_id").alias("payment_id"), F.col("event_id").alias("order_id"),
            F.col("k").alias("product_id"), "user_id",
            F.when(F.col("event_id") % 11 == 0, money(F.lit(0))).otherwise(F.col("val")).alias("pay_amount"),
            F.timestamp_micros(F.unix_micros("ts") + minutes * 60_000_000).alias("pay_time"),
            F.when(F.col("k") % 3 == 0, "JUHUASUAN").otherwise("NONE").alias("activity_type"))

    @cached_property
    def product_refund(self) -> DataFrame:
        return self.events.filter((F.col("event_type") == "purchase") & (F.col("event_id") % 5 == 0)).select(
            F.col("event_id").alias("refund_id"), F.col("event_id").alias("order_id"),
            F.col("k").alias("product_id"), "user_id", F.col("val").alias("refund_amount"),
            F.col("ts").alias("refund_time"), F.lit("goods").alias("refund_type"))

    # ---- ranking domain -------------------------------------------------------------------

    @cached_property
    def board_product(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("product_id"), F.col("p_size").cast("bigint").alias("category_id"),
            F.col("p_name").alias("product_name"), (F.col("p_size").cast("bigint") % 8).alias("price_strength_star"),
            money("p_retailprice").alias("coupon_price"))

    @cached_property
    def board_order(self) -> DataFrame:
        return self.events.filter(F.col("event_type") == "purchase").select(
            F.col("event_id").alias("order_id"), F.col("k").alias("product_id"), "user_id",
            F.col("val").alias("pay_amount"), F.when(F.col("event_id") % 13 != 0, F.col("ts")).alias("pay_time"),
            (F.col("event_id") % 3 + 1).alias("buyer_count"), (F.col("event_id") % 5 + 1).alias("pay_quantity"))

    @cached_property
    def board_traffic(self) -> DataFrame:
        return self.events.filter(F.col("event_type") != "purchase").select(
            F.col("event_id").alias("traffic_id"), F.col("k").alias("product_id"),
            (F.col("event_id") % 6).alias("visitor_count"),
            F.concat_ws("-", "event_type", text(F.col("user_id") % 6)).alias("source"),
            F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("word"), F.col("event_id") % 4)).alias("search_word"),
            F.col("ts").alias("visit_time"))

    @cached_property
    def board_inventory(self) -> DataFrame:
        opened = F.lit("2024-01-01 00:00:00").cast("timestamp")
        return self.raw("part").select(
            F.col("p_partkey").alias("inventory_id"), F.col("p_partkey").alias("sku_id"),
            (F.col("p_size").cast("bigint") * 10).alias("current_stock"),
            (F.col("p_size").cast("bigint") % 30).alias("saleable_days"),
            _plus_hours(opened, F.col("p_partkey") % 30 * 24 + 5).alias("update_time"))

    # ---- entry and path logs --------------------------------------------------------------

    @cached_property
    def entry_log(self) -> DataFrame:
        hour = F.date_trunc("hour", F.col("ts"))
        return self.events.select(
            F.concat(F.lit("p"), "k").alias("page_id"),
            _choice(F.col("k"), "首页", "活动页", "分类页", "宝贝页", "新品页", "商品详情页", "订阅页", "直播页")
            .alias("page_type"),
            F.when(F.col("event_id") % 97 != 0, text("user_id")).alias("visitor_id"),
            hour.alias("visit_time"),
            F.when(F.col("event_type") == "purchase", 1)
            .when((F.col("event_type") == "error") & (F.col("k") == 5), 2).otherwise(0).alias("is_order"),
            F.to_date("ts").alias("data_date"),
            F.when(F.col("user_id") % 2 == 0, "PC").otherwise("Wireless").alias("terminal_type"))

    @cached_property
    def shop_page_log(self) -> DataFrame:
        return self.events.select(
            F.concat(F.lit("s"), "k").alias("shop_page_id"),
            F.concat(F.lit("subtype-"), F.col("k") % 12).alias("shop_page_subtype"),
            F.when(F.col("event_id") % 97 != 0, text("user_id")).alias("visitor_id"),
            F.col("ts").alias("visit_time"),
            F.timestamp_micros(F.unix_micros("ts") + F.floor("val").cast("bigint") * 1_000_000).alias("leave_time"),
            F.to_date("ts").alias("data_date"),
            F.when(F.col("user_id") % 2 == 0, "pc").otherwise("wireless").alias("terminal_type"))

    @cached_property
    def path_log(self) -> DataFrame:
        return self.events.select(
            text("event_id").alias("path_record_id"), text("user_id").alias("visitor_id"),
            F.concat(F.lit("p"), "k").alias("source_page_id"),
            F.col("event_type").alias("source_page_type"),
            F.concat(F.lit("p"), F.col("k") * 7 % 100).alias("target_page_id"),
            _choice(F.col("k"), "view", "click", "purchase").alias("target_page_type"),
            F.col("ts").alias("jump_time"),
            (F.hour("ts") * 60 + F.minute("ts")).cast("int").alias("visit_sequence"),
            F.when(F.col("user_id") % 2 == 0, "pc").otherwise("wireless").alias("terminal_type"))

    # ---- behaviour log --------------------------------------------------------------------

    @cached_property
    def behaviour_log(self) -> DataFrame:
        code = (F.when(F.col("event_type") == "view", "1").when(F.col("event_type") == "click", "2")
                .when(F.col("event_type") == "signup", "3").when(F.col("event_type") == "purchase", "4")
                .otherwise("view"))
        return self.events.select(
            F.col("event_id").alias("id"), text("user_id").alias("user_id"),
            F.concat_ws("_", text("user_id"), F.date_format("ts", "yyyyMMdd")).alias("session_id"),
            F.when(F.col("k") != 99, F.concat(F.lit("S"), F.col("k") % 10)).alias("store_id"),
            text("k").alias("item_id"), text(F.col("k") % 6).alias("page_type"), code.alias("event_type"),
            F.col("ts").alias("event_time"),
            F.when(F.col("event_type") == "click", F.col("k") % 50).alias("search_rank"),
            F.floor("val").cast("bigint").alias("duration"),
            F.when(F.col("k") % 4 != 0, F.col("event_id") % 2).alias("is_new_customer"),
            F.lit(None).cast("bigint").alias("repurchase_flag"),
            F.col("val").alias("acquisition_cost"),
            F.when(F.col("event_id") % 9 != 0, F.col("event_id") % 5 + 1).alias("rating"),
            F.col("ts").alias("update_time"))

    # ---- freight --------------------------------------------------------------------------

    @cached_property
    def freight_region(self) -> DataFrame:
        node = lambda i, p, n: (i.cast("bigint").alias("id"), p.cast("bigint").alias("parent_id"),
                                n.alias("name"))
        provinces = self.raw("region").select(
            *node(F.col("r_regionkey") + 100, F.lit(86), F.concat(F.lit("P-"), "r_name")))
        cities = self.raw("nation").select(
            *node(F.col("n_nationkey") + 1000, F.col("n_regionkey") + 100, F.concat(F.lit("C-"), "n_name")))
        districts = self.raw("supplier").select(
            *node(F.col("s_suppkey") + 10000, F.col("s_suppkey") % 25 + 1000,
                  F.concat(F.lit("D-"), "s_suppkey")))
        return provinces.unionByName(cities).unionByName(districts).withColumn(
            "dict_code", F.concat(F.lit("R"), "id")).withColumn("is_deleted", F.lit("0"))

    @cached_property
    def organ(self) -> DataFrame:
        s = F.col("s_suppkey")
        return self.raw("supplier").select(
            s.alias("id"), F.col("s_name").alias("org_name"),
            F.when(s % 5 == 0, F.lit(1)).otherwise(2).cast("bigint").alias("org_level"),
            F.when(s % 5 == 0, s % 25 + 1000).otherwise(s + 10000).alias("region_id"),
            (s - s % 5).alias("org_parent_id"),
            F.when(s % 40 == 39, "1").otherwise("0").alias("is_deleted"))

    @cached_property
    def freight_dictionary(self) -> DataFrame:
        n = F.col("n_nationkey").cast("bigint")
        rows = F.array(
            F.struct(F.when(n == 8, F.lit(60999)).otherwise(n * 10 + 60010).alias("id"),
                     F.concat(F.lit("status "), n).alias("name"), (n < 9).alias("_ok")),
            F.struct((n + 61001).alias("id"), F.concat(F.lit("cargo "), n).alias("name"), (n < 6).alias("_ok")),
            F.struct((n + 62001).alias("id"), F.concat(F.lit("collect "), n).alias("name"), (n < 2).alias("_ok")),
            F.struct((n + 63001).alias("id"), F.concat(F.lit("payment "), n).alias("name"), (n < 3).alias("_ok")),
            F.struct((n + 64001).alias("id"), F.concat(F.lit("express "), n).alias("name"), (n < 2).alias("_ok")),
            F.struct((n + 65001).alias("id"), F.concat(F.lit("truck "), n).alias("name"), (n < 3).alias("_ok")),
            F.struct((n + 66001).alias("id"), F.concat(F.lit("line "), n).alias("name"), (n < 3).alias("_ok")))
        return self.raw("nation").select(F.inline(rows)).filter("_ok").drop("_ok") \
            .withColumn("is_deleted", F.lit("0"))

    @cached_property
    def waybill(self) -> DataFrame:
        key, d = F.col("o_orderkey"), F.col("o_custkey") % 100
        r = F.col("o_orderkey") % 100
        status = F.when(key % 9 == 8, F.lit(60999)).otherwise(key % 9 * 10 + 60010)
        return self.heads.select(
            key.alias("id"), F.concat(F.lit("YD"), key).alias("order_no"), text(status).alias("status"),
            text(key % 2 + 62001).alias("collect_type"), F.col("o_custkey").alias("user_id"),
            (d + 10000).alias("sender_district_id"), (d % 25 + 1000).alias("sender_city_id"),
            (d % 25 % 5 + 100).alias("sender_province_id"),
            (r + 10000).alias("receiver_district_id"), (r % 25 + 1000).alias("receiver_city_id"),
            (r % 25 % 5 + 100).alias("receiver_province_id"),
            F.concat(F.lit("R"), key).alias("receiver_name"), F.concat(F.lit("S"), "o_custkey").alias("sender_name"),
            text(key % 3 + 63001).alias("payment_type"), (key % 3 + 1).alias("cargo_num"),
            F.col("total").alias("amount"),
            (F.unix_millis("ordered") + 259200000).alias("estimate_arrive_time"),
            (key % 1000).alias("distance"),
            F.concat(F.date_format(_plus_hours(F.col("ordered"), key % 48), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))
            .alias("update_time"),
            F.when(key % 50 == 0, "1").otherwise("0").alias("is_deleted"))

    @cached_property
    def cargo(self) -> DataFrame:
        return self.lines.select(
            F.col("detail_id").alias("id"), F.col("l_orderkey").alias("order_id"),
            text(F.col("l_linenumber").cast("bigint") % 7 + 61001).alias("cargo_type"),
            F.col("qty").alias("volume_length"), (F.col("qty") % 7).alias("volume_width"),
            (F.col("qty") % 5).alias("volume_height"), (F.col("qty") * 2).alias("weight"),
            F.concat(F.date_format(_plus_hours(F.col("ship"), F.col("l_linenumber")), "yyyy-MM-dd'T'HH:mm:ss"),
                     F.lit("Z")).alias("create_time"),
            F.when((F.col("l_linenumber") == 7) & (F.col("l_returnflag") == "N"), "1").otherwise("0")
            .alias("is_deleted"))

    @cached_property
    def transport_task(self) -> DataFrame:
        start = F.unix_millis("ship") + F.col("l_linenumber").cast("bigint") * 3_600_000
        driver2 = F.when(F.col("l_linenumber") % 2 == 1, F.col("l_partkey") % 100 + 200)
        return self.lines.select(
            F.col("detail_id").alias("id"), (F.col("l_partkey") % 25).alias("shift_id"),
            (F.col("l_partkey") % 25 % 10).alias("line_id"), F.col("l_suppkey").alias("start_org_id"),
            (F.col("l_partkey") % 100).alias("end_org_id"), F.col("qty").alias("order_num"),
            (F.col("l_partkey") % 200).alias("driver1_emp_id"),
            F.concat(F.lit("D"), F.col("l_partkey") % 200).alias("driver1_name"),
            driver2.alias("driver2_emp_id"), F.concat(F.lit("E"), driver2).alias("driver2_name"),
            (F.col("l_suppkey") % 25).alias("truck_id"), F.concat(F.lit("TN"), F.col("l_suppkey") % 25).alias("truck_no"),
            start.alias("actual_start_time"),
            F.when((F.col("l_linestatus") != "O") | (F.col("l_returnflag") != "N"),
                   start + F.col("qty") * 900_000).alias("actual_end_time"),
            F.col("price").alias("actual_distance"), F.lit("0").alias("is_deleted"))

    @cached_property
    def shift_base(self) -> DataFrame:
        n = F.col("n_nationkey").cast("bigint")
        return self.raw("nation").select(
            n.alias("id"), (n % 10).alias("line_id"), F.lit("08:00:00").alias("start_time"),
            (n + 1).alias("driver1_emp_id"), (n + 200).alias("driver2_emp_id"), n.alias("truck_id"))

    @cached_property
    def line_base(self) -> DataFrame:
        n = F.col("n_nationkey").cast("bigint")
        return self.raw("nation").filter(n < 10).select(
            n.alias("id"), F.concat(F.lit("line-"), n).alias("name"), F.concat(F.lit("L"), n).alias("line_no"),
            (n % 2 + 1).alias("line_level"), (n * 5).alias("org_id"),
            (n % 3 + 66001).alias("transport_line_type_id"), (n * 40 + 60).alias("estimated_time"),
            (n * 100).alias("distance"))

    @cached_property
    def truck_model(self) -> DataFrame:
        r = F.col("r_regionkey").cast("bigint")
        return self.raw("region").select(
            r.alias("id"), F.concat(F.lit("model "), "r_name").alias("model_name"),
            (r % 3 + 65001).alias("model_type"), (r % 3 + 65001).alias("brand"), (r * 5 + 5).alias("load_weight"))

    @cached_property
    def truck_team(self) -> DataFrame:
        r = F.col("r_regionkey").cast("bigint")
        return self.raw("region").select(
            r.alias("id"), F.concat(F.lit("team "), "r_name").alias("name"), F.concat(F.lit("T"), r).alias("team_no"),
            r.alias("org_id"), (r + 500).alias("manager_emp_id"))

    @cached_property
    def truck_info(self) -> DataFrame:
        n = F.col("n_nationkey").cast("bigint")
        return self.raw("nation").select(
            n.alias("id"), (n % 5).alias("team_id"), F.concat(F.lit("TN"), n).alias("truck_no"),
            (n % 5).alias("truck_model_id"), (n % 2).alias("is_enabled"))

    @cached_property
    def truck_driver(self) -> DataFrame:
        s = F.col("s_suppkey")
        return self.raw("supplier").select(
            s.alias("id"), (s + 1).alias("emp_id"), s.alias("org_id"), (s % 6).alias("team_id"),
            F.lit("B2").alias("license_type"), F.concat(F.lit("LN"), s).alias("license_no"),
            (s % 2).alias("is_enabled"))

    @cached_property
    def express_courier(self) -> DataFrame:
        s = F.col("s_suppkey")
        return self.raw("supplier").select(
            s.alias("id"), (s + 1000).alias("emp_id"), s.alias("org_id"),
            F.concat(F.lit("139"), F.lpad(s.cast("string"), 8, "0")).alias("working_phone"),
            (s % 3 + 64001).alias("express_type"))

    @cached_property
    def courier_complex(self) -> DataFrame:
        s = F.col("s_suppkey")
        return self.raw("supplier").select((s + 1000).alias("courier_emp_id"),
                                           F.floor(s / 3).cast("bigint").alias("complex_id"))

    @cached_property
    def complex_base(self) -> DataFrame:
        c = F.col("s_suppkey")
        return self.raw("supplier").select(
            c.alias("id"), F.concat(F.lit("complex "), c).alias("complex_name"),
            (c % 25 % 5 + 100).alias("province_id"), (c % 25 + 1000).alias("city_id"),
            (c + 10000).alias("district_id"), F.concat(F.lit("D-"), c).alias("district_name"))

    @cached_property
    def org_bound(self) -> DataFrame:
        ship = F.unix_millis("ship")
        return self.lines.select(
            F.col("detail_id").alias("id"), F.col("l_orderkey").alias("order_id"), F.col("l_suppkey").alias("org_id"),
            ship.alias("inbound_time"), (F.col("l_partkey") % 50).alias("inbound_emp_id"),
            F.when(F.col("l_returnflag") != "N", ship + 7_200_000).alias("sort_time"),
            (F.col("l_partkey") % 60).alias("sorter_emp_id"),
            F.when(F.col("l_linestatus") != "O", ship + 14_400_000).alias("outbound_time"),
            (F.col("l_partkey") % 70).alias("outbound_emp_id"))

    @cached_property
    def freight_user(self) -> DataFrame:
        return self.user_info.select(
            "id", "login_name", F.concat(F.lit("nick"), "id").alias("nick_name"),
            F.concat(F.lit("pw"), "id").alias("passwd"), F.col("name").alias("real_name"), "phone_num", "email",
            "user_level", "birthday", "gender", F.unix_millis("create_time").alias("create_time"))

    @cached_property
    def user_address(self) -> DataFrame:
        key = F.col("c_custkey")
        return self.raw("customer").select(
            (key + 1).alias("id"), key.alias("user_id"),
            F.when(key % 9 == 0, "none").otherwise(F.concat(F.lit("152"), F.lpad(key.cast("string"), 8, "0"))).alias("phone"),
            (key % 25 % 5 + 100).alias("province_id"), (key % 25 + 1000).alias("city_id"),
            (key % 100 + 10000).alias("district_id"), F.concat(F.lit("road "), key).alias("address"),
            F.concat(F.date_format(F.date_add(F.lit("2024-01-01"), (key % 30).cast("int")), "yyyy-MM-dd"),
                     F.lit("T01:02:03Z")).alias("create_time"))



    # ---- user labels ----------------------------------------------------------------------

    @cached_property
    def label_categories(self) -> DataFrame:
        size = F.col("p_size").cast("bigint")
        return self.raw("part").select(
            size.alias("id"), text(size).alias("b3name"),
            _choice(size % 10, "手机", "家用电器", "箱包").alias("b1name")).distinct()

    @cached_property
    def label_compare(self) -> DataFrame:
        size = F.col("p_size").cast("bigint") % 10
        return self.raw("part").select(
            _choice(size, "手机", "家用电器", "箱包").alias("category_name"),
            _choice(size, "科技与数码", "性价比", "户外").alias("search_category")).distinct()

    @cached_property
    def label_skus(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("skuid"), F.col("p_size").cast("bigint").alias("c3id"),
            _choice(F.col("p_partkey"), "TCL", "苹果", "小米", "欧莱雅", "香奈儿", "其它").alias("tname"))

    @cached_property
    def label_lines(self) -> DataFrame:
        """Order lines of the label job; amounts around the spending limits."""
        key = F.col("o_orderkey")
        orders = self.heads.select(
            key.alias("order_id"), text(F.col("o_custkey") % 150).alias("uid"),
            (F.unix_millis("ordered") + key % 24 * 3_600_000).alias("create_time"), money(key % 5000).alias("total_amount"))
        lines = self.lines.select("detail_id", F.col("l_orderkey").alias("_o"), F.col("l_partkey").alias("sku_id"),
                                  F.concat(F.lit("sku-"), "l_partkey").alias("sku_name"), F.col("qty").alias("sku_num"))
        return lines.join(orders, lines["_o"] == orders["order_id"]).drop("_o").withColumn("ts_ms", F.col("create_time"))

    @cached_property
    def body_metrics(self) -> DataFrame:
        key = F.col("c_custkey")
        return self.raw("customer").select(
            text(key).alias("uid"), text(key % 50 + 150).alias("height"), F.lit("cm").alias("unit_height"),
            text(key % 40 + 45).alias("weight"), F.lit("kg").alias("unit_weight"))

    # ---- change log and comments ------------------------------------------------------------

    @staticmethod
    def change_log(orders: DataFrame, *tables: str) -> DataFrame:
        """JSON change messages of the named tables (default: all seven), made from order
        rows (batch or stream)."""
        o = Inputs.shape_heads(orders)
        key, ms = F.col("o_orderkey"), F.unix_millis("ordered")
        status = F.col("o_orderstatus")

        def row(**cells):
            return F.map_from_arrays(F.array(*[F.lit(n) for n in cells]), F.array(*[text(c) for c in cells.values()]))

        def change(op, table, before, after, ts, when=None):
            none = F.lit(None).cast("map<string,string>")
            body = F.struct(F.lit(op).alias("op"), (none if before is None else before).alias("before"),
                            after.alias("after"), F.create_map(F.lit("table"), F.lit(table)).alias("source"),
                            ts.alias("ts_ms"))
            return body if when is None else F.when(when, body)

        done = F.when(status == "F", "1002").when(status == "P", "1003").otherwise("1006")
        user, province = F.col("o_custkey"), F.col("o_custkey") % 25
        operate = ms + 7_200_000
        lines = F.transform(F.sequence(F.lit(1), (key % 3 + 1).cast("int")), lambda n: change(
            "c", "order_detail", None, row(
                id=F.concat_ws("-", key, n), order_id=key, sku_id=key * 7 % 1000 + n, sku_name=F.concat(F.lit("sku "), n),
                create_time=ms, sku_num=n, order_price=F.col("total"), split_total_amount=F.col("total"),
                split_activity_amount=key % 11, split_coupon_amount=key % 13), ms + n * 2000))
        rest = [
            change("u", "order_info", row(id=key, order_status=F.lit("1001")),
                   row(id=key, user_id=user, province_id=province, order_status=done, operate_time=operate,
                       create_time=ms, total_amount=F.col("total")), ms),
            change("c", "order_detail_activity", None,
                   row(order_detail_id=F.concat(key, F.lit("-1")), activity_id=key % 6, activity_rule_id=key % 25), ms,
                   key % 2 == 0),
            change("c", "order_detail_coupon", None,
                   row(order_detail_id=F.concat(key, F.lit("-2")), coupon_id=key % 25), ms, key % 3 == 1),
            change("u", "payment_info", row(payment_status=F.lit("1601")),
                   row(user_id=user, order_id=key, payment_type=F.concat(F.lit("110"), key % 6 + 1),
                       callback_time=operate, payment_status=F.lit("1602")), ms + key % 10 * 1000, status == "F"),
            change("u", "order_refund_info", row(refund_status=F.lit("0701")),
                   row(id=key + 1, user_id=user, order_id=key, sku_id=key % 1000, refund_num=key % 3 + 1,
                       refund_amount=F.col("total"), refund_type=F.concat(F.lit("150"), key % 5 + 1),
                       refund_reason_type=F.concat(F.lit("130"), key % 6 + 1), refund_reason_txt=F.lit("reason"),
                       create_time=operate, refund_status=F.when(key % 2 == 0, "0705").otherwise("0702")),
                   ms + 60_000, status == "O"),
            change("u", "refund_payment", row(refund_status=F.lit("1601")),
                   row(id=key + 7, order_id=key, sku_id=F.when(key % 3 == 0, F.lit(-1)).otherwise(key % 1000),
                       payment_type=F.concat(F.lit("110"), key % 6 + 1), callback_time=operate,
                       total_amount=F.col("total"), refund_status=F.lit("1602")), ms + 120_000,
                   (status == "O") & (key % 2 == 0))]
        names = ["order_info", "order_detail_activity", "order_detail_coupon", "payment_info", "order_refund_info",
                 "refund_payment"]
        wanted = [c for name, c in zip(names, rest) if not tables or name in tables]
        parts = [F.filter(F.array(*wanted), lambda c: c.isNotNull())] if wanted else []
        if not tables or "order_detail" in tables:
            parts.append(lines)
        return o.select(F.explode(F.concat(*parts)).alias("c")).select(F.to_json("c").alias("value"))

    @staticmethod
    def cart_changes(events: DataFrame) -> DataFrame:
        """Cart change envelopes: snapshots, rises, falls, and updates without an old row."""
        e, eid = Inputs.shape_events(events).filter(F.col("event_type") == "signup"), F.col("event_id")
        row = lambda n: F.create_map(F.lit("id"), text(eid), F.lit("user_id"), text("user_id"),
                                     F.lit("sku_id"), text("k"), F.lit("sku_num"), text(n))
        return e.select(
            F.when(eid % 3 == 0, "r").otherwise("u").alias("op"),
            F.when(eid % 3 == 1, row(eid % 5)).alias("before"), row(eid % 7 + 1).alias("after"),
            F.create_map(F.lit("table"), F.lit("cart_info")).alias("source"), F.unix_millis("ts").alias("ts_ms"))

    @staticmethod
    def comment_changes(documents: DataFrame) -> DataFrame:
        key = F.col("doc_id")
        return documents.select(
            F.lit("c").alias("op"), F.lit(None).cast("map<string,string>").alias("before"),
            F.create_map(F.lit("id"), text(key), F.lit("user_id"), text(key % 100), F.lit("sku_id"), text(key % 50),
                         F.lit("appraise"), F.concat(F.lit("120"), key % 6 + 1), F.lit("comment_txt"), F.col("text"))
            .alias("after"),
            F.create_map(F.lit("table"), F.lit("comment_info")).alias("source"), (key * 1000).alias("ts_ms"))

    @cached_property
    def listed_words(self) -> DataFrame:
        """Words to screen for: the last comma-separated part of every text labelled toxic."""
        toxic = self.raw("labels").filter(F.col("toxic") == 1).select("doc_id")
        return self.raw("documents").join(toxic, "doc_id").select(
            F.element_at(F.split("text", ","), -1).alias("word")).distinct()
