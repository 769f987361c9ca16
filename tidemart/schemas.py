"""Declared schemas; nothing in the package infers a schema from data."""

from pyspark.sql import types as T

_S, _L, _TS = T.StringType(), T.LongType(), T.TimestampType()


def _fields(spec: str, kind: T.DataType) -> list[T.StructField]:
    return [T.StructField(name, kind) for name in spec.split()]


STRING_MAP = T.MapType(_S, _S)

CDC = T.StructType([
    T.StructField("op", _S),
    T.StructField("before", STRING_MAP),
    T.StructField("after", STRING_MAP),
    T.StructField("source", STRING_MAP),
    T.StructField("ts_ms", _L),
])

LOG_COMMON = T.StructType(_fields("ar ba ch is_new md mid os sid uid vc", _S))
LOG_PAGE = T.StructType(
    _fields("item item_type last_page_id page_id from_pos_id from_pos_seq refer_id", _S)
    + [T.StructField("during_time", _L)]
)
PAGE_LOG = T.StructType([
    T.StructField("common", LOG_COMMON),
    T.StructField("page", LOG_PAGE),
    T.StructField("displays", T.ArrayType(STRING_MAP)),
    T.StructField("actions", T.ArrayType(STRING_MAP)),
    T.StructField("start", STRING_MAP),
    T.StructField("err", STRING_MAP),
    T.StructField("ts", _L),
])

VEHICLE_POSITION = T.StructType(
    [T.StructField("id", _L), T.StructField("msid", _S), T.StructField("datatype", _L),
     T.StructField("data", _S)]
    + _fields("upexgmsgregister alarm state vehicleno", _S)
    + _fields("datalen vehiclecolor vec1 vec2 vec3 encrypy altitude msgId direction", _L)
    + [T.StructField("lon", T.DoubleType()), T.StructField("lat", T.DoubleType()),
       T.StructField("dateTime", _S), T.StructField("ds", T.DateType()), T.StructField("ts", _L)]
)

ENTRY_LOG = T.StructType([
    T.StructField("page_id", _S), T.StructField("page_type", _S), T.StructField("visitor_id", _S),
    T.StructField("visit_time", _TS), T.StructField("is_order", T.IntegerType()),
    T.StructField("data_date", T.DateType()), T.StructField("terminal_type", _S),
])

SHOP_PAGE_LOG = T.StructType([
    T.StructField("shop_page_id", _S), T.StructField("shop_page_subtype", _S),
    T.StructField("visitor_id", _S), T.StructField("visit_time", _TS),
    T.StructField("leave_time", _TS), T.StructField("data_date", T.DateType()),
    T.StructField("terminal_type", _S),
])

PATH_LOG = T.StructType([
    T.StructField("path_record_id", _S), T.StructField("visitor_id", _S),
    T.StructField("source_page_id", _S), T.StructField("source_page_type", _S),
    T.StructField("target_page_id", _S), T.StructField("target_page_type", _S),
    T.StructField("jump_time", _TS), T.StructField("visit_sequence", T.IntegerType()),
    T.StructField("terminal_type", _S),
])

DIM_CONFIG = T.StructType(
    _fields("source_table sink_table sink_columns sink_family sink_row_key op", _S)
)
