"""Tables stored in buckets of a key.

Rows of a key are in one bucket, sorted by it, and the catalog knows: joins and sums by the key of tables with
the same buckets need no shuffle. All rows of one key are in one task; where a key may hold a large
share of the rows, keep `tables.write_distributed`, which deals a key's rows out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

BUCKET_BYTES = 128 << 20


def buckets_for(df: DataFrame, bucket_bytes: int = BUCKET_BYTES, least: int = 1, most: int = 1 << 16) -> int:
    """Buckets of about `bucket_bytes`, a power of two, from Spark's estimate of the input. Tables that are joined
    take the number of the largest."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    wanted = min(most, max(least, -(-size // bucket_bytes)))
    return 1 << (wanted - 1).bit_length()


def write_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int, path: str | None = None,
                   mode: str = "error") -> DataFrame:
    """Write `df` as a bucketed, sorted catalog table and return it; one file a bucket, made by one shuffle on the keys."""
    writer = df.repartition(buckets, *keys).write.format("parquet").mode(mode).bucketBy(buckets, *keys).sortBy(*keys)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)
