"""Tables that a job writes in the shared folder and reads again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` written once as Parquet and read back: a lost executor costs no recomputation."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


PART_BYTES = 128 << 20
UNKNOWN = 1 << 60   # Spark's estimate for data whose size it can't know is about 2**63


def parts_for(df: DataFrame, part_bytes: int = PART_BYTES) -> int:
    """Partitions for a shuffle of whole rows: those of the session, or more where the input's size, if known, asks for more."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // part_bytes) if size < UNKNOWN else 1)
