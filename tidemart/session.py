"""Session settings, scratch space and lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job of this package relies on. AQE splits hot join
# partitions and picks broadcast joins from measured sizes, so no plan carries
# an unchecked broadcast hint.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def tuned(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "tidemart", master: str | None = None, **conf: str) -> SparkSession:
    """Session for tests and the bench; on a cluster pass the given session to `tuned`."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return tuned(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the session's `spark.checkpoint.dir`.

    Only a local-mode session without that setting gets a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return os.path.dirname(current.rstrip("/"))
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    own = tempfile.mkdtemp(prefix="tidemart-")
    spark.sparkContext.setCheckpointDir(own)
    return own


def scratch_path(spark: SparkSession, name: str) -> str:
    """New, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write `df` as a table in the shared folder and continue from the files.

    A lost executor then re-reads files instead of recomputing the shuffles
    behind them, and values that depend on the physical layout stay fixed.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
