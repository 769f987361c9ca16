"""Freight dimensions. Every source keeps only rows that are not logically deleted."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.cleaning import hashed, hashed_email, hashed_phone, not_deleted
from ..functions.timekeys import date_from_epoch_day, from_millis, iso_text
from ..operators.history import OPEN_END, open_versions
from ..operators.joins import attach, attach_parent
from ..operators.lists import member_counts


def live(df: DataFrame) -> DataFrame:
    return df.filter(not_deleted()) if "is_deleted" in df.columns else df


def complex_dim(complexes: DataFrame, regions: DataFrame, courier_links: DataFrame) -> DataFrame:
    """Residential areas with place names and the number of their couriers; `lists.members` has these."""
    regions = live(regions)
    out = attach(live(complexes), regions, "province_id", "id", {"province_name": "name"}, "inner")
    out = attach(out, regions, "city_id", "id", {"city_name": "name"}, "inner")
    couriers = member_counts(live(courier_links), ["complex_id"], F.col("courier_emp_id"), "courier_count")
    return attach(out, couriers, "id", "complex_id", ["courier_count"])


def organ_dim(organs: DataFrame, regions: DataFrame) -> DataFrame:
    out = attach(live(organs), live(regions), "region_id", "id",
                 {"region_name": "name", "region_code": "dict_code"})
    return attach_parent(out, "id", "org_parent_id", {"org_parent_name": "org_name"})


def region_dim(regions: DataFrame) -> DataFrame:
    return live(regions).select("id", "parent_id", "name", "dict_code")


def courier_dim(couriers: DataFrame, organs: DataFrame, dictionary: DataFrame) -> DataFrame:
    out = live(couriers).withColumn("working_phone", hashed(F.col("working_phone")))
    out = attach(out, live(organs), "org_id", "id", ["org_name"], "inner")
    return attach(out, live(dictionary), "express_type", "id", {"express_type_name": "name"}, "inner")


def shift_dim(shifts: DataFrame, lines: DataFrame, dictionary: DataFrame) -> DataFrame:
    out = attach(live(shifts), live(lines), "line_id", "id",
                 {"line_name": "name", "line_no": "line_no", "line_level": "line_level", "org_id": "org_id",
                  "transport_line_type_id": "transport_line_type_id", "distance": "distance",
                  "estimated_time": "estimated_time"}, "inner")
    return attach(out, live(dictionary), "transport_line_type_id", "id",
                  {"transport_line_type_name": "name"}, "inner")


def driver_dim(drivers: DataFrame, organs: DataFrame, teams: DataFrame) -> DataFrame:
    out = attach(live(drivers), live(organs), "org_id", "id", ["org_name"], "inner")
    return attach(out, live(teams), "team_id", "id", {"team_name": "name"}, "inner")


def truck_dim(trucks: DataFrame, teams: DataFrame, models: DataFrame, organs: DataFrame,
              dictionary: DataFrame) -> DataFrame:
    out = live(trucks).withColumn("truck_no", hashed(F.col("truck_no")))
    out = attach(out, live(teams), "team_id", "id", {
        "team_name": "name", "team_no": "team_no", "org_id": "org_id", "manager_emp_id": "manager_emp_id"}, "inner")
    out = attach(out, live(models), "truck_model_id", "id", {
        "truck_model_name": "model_name", "truck_model_type": "model_type", "truck_brand": "brand",
        "load_weight": "load_weight"}, "inner")
    out = attach(out, live(organs), "org_id", "id", ["org_name"], "inner")
    names = live(dictionary)
    out = attach(out, names, "truck_model_type", "id", {"truck_model_type_name": "name"}, "inner")
    return attach(out, names, "truck_brand", "id", {"truck_brand_name": "name"}, "inner")


def user_zip(users: DataFrame) -> DataFrame:
    """Users with personal data hashed; badly formed phone or mail becomes NULL."""
    return open_versions(live(users).select(
        "id", "login_name", "nick_name", hashed(F.col("passwd")).alias("passwd"),
        hashed(F.col("real_name")).alias("realname"), hashed_phone(F.col("phone_num")).alias("phone_num"),
        hashed_email(F.col("email")).alias("email"), "user_level",
        date_from_epoch_day(F.col("birthday")).alias("birthday"), "gender", "create_time"),
        F.to_date(from_millis(F.col("create_time"))), OPEN_END).drop("create_time")


def address_zip(addresses: DataFrame) -> DataFrame:
    return open_versions(live(addresses).select(
        "id", "user_id", hashed_phone(F.col("phone")).alias("phone"), "province_id", "city_id", "district_id",
        "address", iso_text(F.col("create_time")).alias("_start")), F.col("_start"), OPEN_END).drop("_start")
