"""Day-partitioned tables: rewriting days, accumulating reports, retention."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F


def overwrite_days(df: DataFrame, path: str, day: str = "dt", fmt: str = "parquet") -> None:
    """Rewrite exactly the days present in `df`; running it again changes nothing.

    The rebalance hint lets AQE give a large day several files and join small ones.
    """
    (df.hint("rebalance", day).write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(day).save(path))


def accumulate_report(report: DataFrame, path: str, day: str = "dt") -> None:
    """Add a day's report to the table that keeps all days. Rows are distinct, and a
    day that is reported again replaces only itself."""
    overwrite_days(report.distinct(), path, day)


def _filesystem(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def list_partitions(spark: SparkSession, path: str, column: str = "dt") -> list[str]:
    """Partition values from the directory names; no data is read."""
    fs, target = _filesystem(spark, path)
    names = [status.getPath().getName() for status in fs.listStatus(target) if status.isDirectory()]
    prefix = f"{column}="
    return sorted(n[len(prefix):] for n in names if n.startswith(prefix))


def expired(days: list[str], as_of: date, keep_past: int = 180, keep_ahead: int = 30) -> list[str]:
    low, high = as_of - timedelta(days=keep_past), as_of + timedelta(days=keep_ahead)
    return [d for d in days if not low <= date.fromisoformat(d) <= high]


def retain_days(spark: SparkSession, path: str, as_of: date, keep_past: int = 180, keep_ahead: int = 30,
                column: str = "dt") -> list[str]:
    """Drop the day partitions outside the kept range; returns the dropped days."""
    old = expired(list_partitions(spark, path, column), as_of, keep_past, keep_ahead)
    for day in old:
        fs, target = _filesystem(spark, f"{path}/{column}={day}")
        fs.delete(target, True)
    return old


def write_distributed(df: DataFrame, path: str, day: str, key: str, buckets: int = 16, mode: str = "append") -> None:
    """Day partitions whose rows are spread over files by a key.

    The key hash alone would leave a key with a third of the rows in one task, so a
    row hash splits each bucket further before AQE balances the sizes.
    """
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).alias("_bucket")
    spread = df.withColumn("_bucket", bucket).hint("rebalance", day, "_bucket").drop("_bucket")
    spread.write.mode(mode).partitionBy(day).parquet(path)


def recover_partitions(spark: SparkSession, table: str) -> None:
    """Make partitions written straight to the files visible in the catalog."""
    spark.catalog.recoverPartitions(table)


def create_day_table(spark: SparkSession, table: str, path: str, df: DataFrame, day: str = "dt",
                     fmt: str = "parquet") -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING {fmt} PARTITIONED BY (`{day}`) LOCATION '{path}'")
