"""Freight facts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..functions.cleaning import hashed, masked_name, status_not_in
from ..functions.timekeys import from_iso, from_millis
from ..operators.joins import attach, attach_roles
from .freight_dims import live

# Waybill status codes from placed to signed, and cancelled.
PLACED, PAID, TAKEN, STORED, SENT, ARRIVED, OUT_FOR_DELIVERY, SIGNED, CANCELLED = (
    "60010", "60020", "60030", "60040", "60050", "60060", "60070", "60080", "60999")
CLOSED = (SIGNED, CANCELLED)


@dataclass(frozen=True)
class Stage:
    """A waybill milestone: name of its time column and the status codes not there yet."""

    time_column: str
    excluded: tuple[str, ...] = ()
    only: tuple[str, ...] = ()
    from_cargo: bool = False
    how: str = "inner"


STAGES = {
    "order": Stage("order_time", from_cargo=True, how="left"),
    "pay": Stage("payment_time", (PLACED, CANCELLED)),
    "cancel": Stage("cancel_time", only=(CANCELLED,)),
    "receive": Stage("receive_time", (PLACED, PAID, CANCELLED)),
    "dispatch": Stage("dispatch_time", (PLACED, PAID, TAKEN, STORED, CANCELLED)),
    "bound_finish": Stage("bound_finish_time", (PLACED, PAID, TAKEN, STORED, SENT, CANCELLED)),
    "deliver": Stage("deliver_suc_time", (PLACED, PAID, TAKEN, STORED, SENT, ARRIVED, CANCELLED)),
    "sign": Stage("sign_time", (PLACED, PAID, TAKEN, STORED, SENT, ARRIVED, OUT_FOR_DELIVERY, CANCELLED)),
}

_CARGO = ["id", "order_id", "cargo_type", "volume_length", "volume_width", "volume_height", "weight"]
_PLACES = [f"{side}_{level}_id" for side in ("receiver", "sender") for level in ("province", "city", "district")]
_BILL = ["order_no", "status", "collect_type", "user_id", *_PLACES, "payment_type", "cargo_num", "amount", "distance"]


def waybill_core(cargo: DataFrame, waybills: DataFrame, stage: Stage) -> DataFrame:
    """Cargo rows of the waybills that reached a stage, without dictionary names."""
    bills = live(waybills).filter(status_not_in(F.col("status"), stage.excluded))
    if stage.only:
        bills = bills.filter(F.col("status").isin(list(stage.only)))
    reached = from_iso(F.col("update_time"))
    bills = bills.select(
        F.col("id").alias("_bill"), *_BILL, masked_name(F.col("receiver_name")).alias("receiver_name"),
        masked_name(F.col("sender_name")).alias("sender_name"),
        from_millis(F.col("estimate_arrive_time")).alias("estimate_arrive_time"), reached.alias("_reached"))
    goods = live(cargo).select(*_CARGO, from_iso(F.col("create_time")).alias("_ordered"))
    out = goods.join(bills, goods["order_id"] == bills["_bill"], stage.how).drop("_bill")
    time = F.col("_ordered") if stage.from_cargo else F.col("_reached")
    return out.withColumn(stage.time_column, time).withColumn("dt", F.to_date(time))


def waybill_fact(cargo: DataFrame, waybills: DataFrame, dictionary: DataFrame, stage: Stage) -> DataFrame:
    core = waybill_core(cargo, waybills, stage).drop("_ordered", "_reached")
    roles = {"cargo_type": "cargo_type_name", "status": "status_name", "collect_type": "collect_type_name",
             "payment_type": "payment_type_name"}
    return attach_roles(core, live(dictionary), "id", "name", roles)


def waybill_process(cargo: DataFrame, waybills: DataFrame, dictionary: DataFrame,
                    open_end: str = "9999-12-31") -> DataFrame:
    """One row per cargo from order to close; open waybills end in the far future."""
    core = waybill_core(cargo, waybills, Stage("order_time", from_cargo=True))
    end = F.when(F.col("status").isin(list(CLOSED)), F.to_date("_reached")).otherwise(F.lit(open_end).cast("date"))
    out = core.withColumn("end_date", end).withColumn("start_date", F.col("dt")).drop("_ordered", "_reached", "dt")
    return attach_roles(out, live(dictionary), "id", "name",
                        {"cargo_type": "cargo_type_name", "status": "status_name",
                         "collect_type": "collect_type_name", "payment_type": "payment_type_name"})


def transport_finish_fact(tasks: DataFrame, shifts: DataFrame, organs: DataFrame | None = None) -> DataFrame:
    """Finished transports with their duration and the time they were due."""
    done = live(tasks).filter(F.col("actual_end_time").isNotNull())
    start, end = from_millis(F.col("actual_start_time")), from_millis(F.col("actual_end_time"))
    out = done.select(
        "id", "shift_id", "line_id", "start_org_id", "end_org_id", "order_num", "driver1_emp_id",
        masked_name(F.col("driver1_name")).alias("driver1_name"), "driver2_emp_id",
        masked_name(F.col("driver2_name")).alias("driver2_name"), "truck_id",
        hashed(F.col("truck_no")).alias("truck_no"), start.alias("actual_start_time"),
        end.alias("actual_end_time"), "actual_distance",
        ((F.col("actual_end_time") - F.col("actual_start_time")) / 1000).cast("bigint").alias("finish_dur_sec"),
        F.to_date(end).alias("dt"))
    out = attach(out, shifts, "shift_id", "id", {"estimated_time": "estimated_time"})
    due = F.timestamp_seconds(F.unix_seconds("actual_start_time") + F.col("estimated_time") * 60)
    out = out.withColumn("estimate_end_time", due).drop("estimated_time")
    if organs is None:
        return out
    return attach(out, organs, "start_org_id", "id", {"start_org_name": "org_name"})


def inbound_fact(bounds: DataFrame) -> DataFrame:
    return _bound(bounds, "inbound_time", "inbound_emp_id")


def sort_fact(bounds: DataFrame) -> DataFrame:
    return _bound(bounds, "sort_time", "sorter_emp_id")


def outbound_fact(bounds: DataFrame) -> DataFrame:
    return _bound(bounds, "outbound_time", "outbound_emp_id")


def _bound(bounds: DataFrame, time: str, employee: str) -> DataFrame:
    """Rows whose milestone has happened, with its time as timestamp and day."""
    at = from_millis(F.col(time))
    return live(bounds).filter(F.col(time).isNotNull()).select(
        "id", "order_id", "org_id", at.alias(time), employee, F.to_date(at).alias("dt"))
