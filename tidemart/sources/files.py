"""Text and columnar files with declared schemas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.timekeys import COMPACT_DAY


def read_tsv(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> DataFrame:
    return spark.read.schema(schema).csv(path, sep="\t", header=header, mode="PERMISSIVE")


def with_partition(df: DataFrame, ts_col: str, out: str = "dt", pattern: str = COMPACT_DAY) -> DataFrame:
    """Add the day partition of a time column; rows without a time are left out."""
    return df.filter(F.col(ts_col).isNotNull()).withColumn(out, F.date_format(ts_col, pattern))


def write_columnar(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (),
                   compression: str = "snappy", mode: str = "errorifexists") -> None:
    if fmt not in ("parquet", "orc"):
        raise ValueError(f"unsupported format {fmt}")
    df.write.format(fmt).mode(mode).option("compression", compression).partitionBy(*partition_by).save(path)
