"""Trade facts from a change log.

All functions take parsed change envelopes (see sources.cdc) or rows made from them, and
work on batch and streaming frames alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F

from .. import schemas
from ..functions.keys import row_key
from ..functions.timekeys import DAY, millis_text
from ..operators.joins import attach
from ..sources.cdc import after, of_table
from ..sources.upsert import DAY_MS, UpsertTable
from .joins import interval_join, lookup

# Order, payment and refund status codes.
UNPAID, CANCELLED, REFUND_DONE_ORDER = "1001", "1003", "1006"
PAID, REFUNDED = "1602", "0705"


def _date_id(column: str):
    return millis_text(F.col(column), DAY).alias("date_id")


def cart_adds(changes: DataFrame) -> DataFrame:
    """Items added: a snapshot row counts in full, an update by how much it rose."""
    rows = of_table(changes, "cart_info")
    now = F.col("after")["sku_num"].try_cast("bigint")
    old = F.col("before")["sku_num"].try_cast("bigint")
    rose = (F.col("op") == "u") & old.isNotNull() & (now > old)
    added = F.when(F.col("op") == "r", now).otherwise(now - old)
    return rows.filter((F.col("op") == "r") | rose).select(*after("id", "user_id", "sku_id"), added.alias("sku_num"), "ts_ms")


#: Source table and cells that make the four parts of an order line.
PART_CELLS = {
    "detail": ("order_detail", ["id", "order_id", "sku_id", "sku_name", "create_time", "sku_num", "order_price",
                                "split_total_amount", "split_activity_amount", "split_coupon_amount"]),
    "order": ("order_info", ["id", "user_id", "province_id"]),
    "activity": ("order_detail_activity", ["order_detail_id", "activity_id", "activity_rule_id"]),
    "coupon": ("order_detail_coupon", ["order_detail_id", "coupon_id"])}


def _part(cells: DataFrame, part: str) -> DataFrame:
    """Rows of a part from a frame with its cells and `ts_ms`."""
    names = PART_CELLS[part][1]
    if part != "detail":
        return cells.select(*names, "ts_ms")
    amount = lambda n: F.col(n).try_cast("decimal(16,2)")
    return cells.select(
        *names[:6], (amount("sku_num") * amount("order_price")).cast("decimal(16,2)").cast("string").alias("split_original_amount"),
        *names[7:], "ts_ms")


def _part_rows(changes: DataFrame, part: str) -> DataFrame:
    table, names = PART_CELLS[part]
    return _part(of_table(changes, table).select(*after(*names), "ts_ms"), part)


def order_rows(changes: DataFrame) -> DataFrame:
    return _part_rows(changes, "order")


def detail_rows(changes: DataFrame) -> DataFrame:
    return _part_rows(changes, "detail")


def activity_rows(changes: DataFrame) -> DataFrame:
    return _part_rows(changes, "activity")


def coupon_rows(changes: DataFrame) -> DataFrame:
    return _part_rows(changes, "coupon")


def detail_join(details: DataFrame, orders: DataFrame, activities: DataFrame, coupons: DataFrame) -> DataFrame:
    """Order lines with their order, and with activity and coupon where there is one."""
    out = attach(details, orders, "order_id", "id", ["user_id", "province_id"], "inner")
    out = attach(out, activities, "id", "order_detail_id", ["activity_id", "activity_rule_id"])
    out = attach(out, coupons, "id", "order_detail_id", ["coupon_id"])
    return out.withColumn("date_id", millis_text(F.col("create_time"), DAY))


class OrderDetailJoin:
    """Order lines from four change streams whose rows may arrive in any order and batch.

    Each batch adds its rows to small keyed tables, finds the order lines it touches, joins
    them again from the tables and upserts the result. With a retention, rows older than it
    are neither read nor joined, which bounds the work of a batch.
    """

    PARTS = {"detail": (detail_rows, ["id"]), "order": (order_rows, ["id"]),
             "activity": (activity_rows, ["order_detail_id"]), "coupon": (coupon_rows, ["order_detail_id"])}

    def __init__(self, spark, root: str, retention_ms: int | None = None, slice_ms: int = DAY_MS):
        empty = spark.createDataFrame([], schemas.CDC)
        self.retention_ms = retention_ms
        self.parts = {name: UpsertTable(spark, f"{root}/{name}", make(empty).schema, keys,
                                        retention_ms=retention_ms, slice_ms=slice_ms) for name, (make, keys) in self.PARTS.items()}
        joined = detail_join(*[make(empty) for make, _ in self.PARTS.values()])
        self.result = UpsertTable(spark, f"{root}/joined", joined.schema, ["id"], slice_ms=slice_ms)

    def step(self, batch: DataFrame, batch_id: int) -> None:
        """One micro-batch, for `runner.per_batch`. What the parts need of it is kept as plain columns, as the
        messages with their maps are many times as large and slow to read."""
        wide = self._wide(batch).persist(StorageLevel.DISK_ONLY)
        try:
            self._merge(wide, batch_id)
        finally:
            wide.unpersist()

    def _wide(self, batch: DataFrame) -> DataFrame:
        """The messages of the four tables, the cells that count in columns by their place; with a retention the
        other messages too, as their times count."""
        table = F.col("source")["table"]
        names = F.lit(None).cast("array<string>")
        for source, cells in PART_CELLS.values():
            names = F.when(table == source, F.array(*[F.lit(n) for n in cells])).otherwise(names)
        wanted = batch if self.retention_ms is not None else of_table(batch, *[source for source, _ in PART_CELLS.values()])
        # One pass over the names: an expression for each column and table makes code too long to be compiled.
        found = wanted.select(table.alias("_table"), "ts_ms", F.transform(names, lambda n: F.try_element_at("after", n)).alias("_cells"))
        return found.select("_table", "ts_ms", *[F.get("_cells", F.lit(k)).alias(f"_{k}") for k in range(max(len(c) for _, c in PART_CELLS.values()))])

    def _merge(self, wide: DataFrame, batch_id: int) -> None:
        now = wide.agg(F.max("ts_ms")).first()[0] if self.retention_ms is not None else None
        changed = {part: _part(wide.filter(F.col("_table") == source).select(*[F.col(f"_{k}").alias(n) for k, n in enumerate(names)], "ts_ms"), part)
                   for part, (source, names) in PART_CELLS.items()}
        for name, rows in changed.items():
            self.parts[name].upsert(rows, batch_id)
        tables = {name: table.latest(now) for name, table in self.parts.items()}
        lines = changed["detail"].select("id")
        for name in ("activity", "coupon"):
            lines = lines.unionByName(changed[name].select(F.col("order_detail_id").alias("id")))
        orders = changed["order"].select(F.col("id").alias("order_id"))
        mark = lambda keys, name: keys.distinct().withColumn(name, F.lit(True))
        marked = tables["detail"].join(mark(lines, "_line"), "id", "left").join(mark(orders, "_order"), "order_id", "left")
        details = marked.filter(F.col("id").isNotNull() & (F.col("_line") | F.col("_order"))).drop("_line", "_order")
        self.result.upsert(detail_join(details, tables["order"], tables["activity"], tables["coupon"]), batch_id)


_LINE = ["order_id", "user_id", "sku_id", "province_id", "activity_id", "activity_rule_id", "coupon_id", "sku_num",
         "split_original_amount", "split_activity_amount", "split_coupon_amount", "split_total_amount"]


def cancellations(changes: DataFrame) -> DataFrame:
    """Orders that went from unpaid to cancelled."""
    went = (F.col("op") == "u") & (F.col("before")["order_status"] == UNPAID) & (F.col("after")["order_status"] == CANCELLED)
    return of_table(changes, "order_info").filter(went).select(
        F.col("after")["id"].alias("cancelled_id"), F.col("after")["operate_time"].alias("operate_time"),
        F.col("ts_ms").alias("cancel_ms"))


Timed = Callable[[DataFrame, str, str], DataFrame]


def cancelled_lines(lines: DataFrame, cancelled: DataFrame, timed: Timed, before: str, after_: str) -> DataFrame:
    """Lines of cancelled orders; `timed(df, millis, out)` adds event time and watermark."""
    left, right = timed(cancelled, "cancel_ms", "cancel_et"), timed(lines, "ts_ms", "line_et")
    out = interval_join(left, right, [("cancelled_id", "order_id")], "cancel_et", "line_et", before, after_)
    return out.select("id", *_LINE, _date_id("operate_time"), "operate_time", F.col("cancel_ms").alias("ts_ms"))


def payments(changes: DataFrame) -> DataFrame:
    """Payments that succeeded."""
    paid = (F.col("op") == "u") & (F.col("after")["payment_status"] == PAID)
    return of_table(changes, "payment_info").filter(paid).select(
        F.col("after")["user_id"].alias("pay_user_id"), F.col("after")["order_id"].alias("pay_order_id"),
        row_key(F.col("after")["payment_type"]).alias("payment_type_code"),
        F.col("after")["callback_time"].alias("callback_time"), F.col("ts_ms").alias("pay_ms"))


def paid_lines(paid: DataFrame, lines: DataFrame, dictionary: DataFrame, timed: Timed, before: str = "5 SECONDS",
               after_: str = "5 SECONDS") -> DataFrame:
    """Lines of paid orders near the payment's time, with the payment type's name."""
    left, right = timed(paid, "pay_ms", "pay_et"), timed(lines, "ts_ms", "line_et")
    out = interval_join(left, right, [("pay_order_id", "order_id")], "pay_et", "line_et", before, after_)
    out = lookup(out, dictionary, "payment_type_code", "dic_key", "dic_name", "payment_type_name")
    return out.select(F.col("id").alias("order_detail_id"), *_LINE[:-1], "payment_type_code", "payment_type_name",
                      "callback_time", F.col("split_total_amount").alias("split_payment_amount"),
                      F.col("pay_ms").alias("ts_ms"))


def refund_requests(changes: DataFrame) -> DataFrame:
    return of_table(changes, "order_refund_info").select(
        *after("id", "user_id", "order_id", "sku_id", "refund_num", "refund_amount", "refund_reason_txt", "create_time"),
        row_key(F.col("after")["refund_type"]).alias("refund_type_code"),
        row_key(F.col("after")["refund_reason_type"]).alias("refund_reason_type_code"), F.col("ts_ms").alias("refund_ms"))


def requested_refunds(requests: DataFrame, orders: DataFrame, dictionary: DataFrame, timed: Timed, before: str,
                      after_: str) -> DataFrame:
    """Refund requests with the province of their order and two dictionary names."""
    heads = orders.select(F.col("id").alias("_order"), "province_id", F.col("ts_ms").alias("order_ms"))
    left, right = timed(requests, "refund_ms", "refund_et"), timed(heads, "order_ms", "order_et")
    out = interval_join(left, right, [("order_id", "_order")], "refund_et", "order_et", before, after_)
    out = lookup(out, dictionary, "refund_type_code", "dic_key", "dic_name", "refund_type_name")
    out = lookup(out, dictionary, "refund_reason_type_code", "dic_key", "dic_name", "refund_reason_type_name")
    return out.select("id", "user_id", "order_id", "sku_id", "province_id", _date_id("create_time"), "create_time",
                      "refund_type_code", "refund_type_name", "refund_reason_type_code", "refund_reason_type_name",
                      "refund_reason_txt", "refund_num", "refund_amount", F.col("refund_ms").alias("ts_ms"))


def _changed_to(column: str, value: str):
    return (F.col("op") == "u") & F.col("before")[column].isNotNull() & (F.col("after")[column] == value)


def refund_payments(changes: DataFrame) -> DataFrame:
    return of_table(changes, "refund_payment").filter(_changed_to("refund_status", PAID)).select(
        *after("id", "order_id", "sku_id", "callback_time", "total_amount"),
        row_key(F.col("after")["payment_type"]).alias("payment_type_code"), F.col("ts_ms").alias("refund_ms"))


def finished_refunds(changes: DataFrame) -> DataFrame:
    return of_table(changes, "order_refund_info").filter(_changed_to("refund_status", REFUNDED)).select(
        F.col("after")["order_id"].alias("done_order"), F.col("after")["sku_id"].alias("done_sku"),
        F.col("after")["refund_num"].alias("refund_num"), F.col("ts_ms").alias("done_ms"))


def refunded_orders(changes: DataFrame) -> DataFrame:
    return of_table(changes, "order_info").filter(_changed_to("order_status", REFUND_DONE_ORDER)).select(
        F.col("after")["id"].alias("refunded_id"), *after("user_id", "province_id"), F.col("ts_ms").alias("order_ms"))


def paid_refunds(refunds: DataFrame, finished: DataFrame, orders: DataFrame, dictionary: DataFrame, timed: Timed,
                 before: str, after_: str, names: str = "inner") -> DataFrame:
    """Refund payments with the finished request (order and sku) and the refunded order.

    Only one event time may go on into the second join, so the request's is dropped.
    """
    first = interval_join(timed(refunds, "refund_ms", "refund_et"), timed(finished, "done_ms", "done_et"),
                          [("order_id", "done_order"), ("sku_id", "done_sku")], "refund_et", "done_et", before, after_)
    first = first.drop("done_et", "done_ms", "done_order", "done_sku")
    out = interval_join(first, timed(orders, "order_ms", "order_et"), [("order_id", "refunded_id")], "refund_et",
                        "order_et", before, after_)
    out = lookup(out, dictionary, "payment_type_code", "dic_key", "dic_name", "payment_type_name", names)
    return out.select("id", "user_id", "order_id", "sku_id", "province_id", "payment_type_code", "payment_type_name",
                      _date_id("callback_time"), "callback_time", "refund_num", "total_amount",
                      F.col("refund_ms").alias("ts_ms"))


def comments(changes: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Comments with the name of their appraisal."""
    rows = of_table(changes, "comment_info").select(
        *after("id", "user_id", "sku_id", "comment_txt"), row_key(F.col("after")["appraise"]).alias("appraise"), "ts_ms")
    return lookup(rows, dictionary, "appraise", "dic_key", "dic_name", "appraise_name")


def keyed_dictionary(dictionary: DataFrame) -> DataFrame:
    """Dictionary under the hashed key of the dimension store; the name sits in a struct there."""
    return dictionary.select(row_key(F.col("dic_code")).alias("dic_key"), F.struct("dic_name").alias("info")) \
        .select("dic_key", F.col("info.dic_name").alias("dic_name"))
