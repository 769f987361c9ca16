"""Running streams: checkpoints, triggers, idempotent batch writes."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

CHECKPOINT_SECONDS = 30


def _trigger(writer, once: bool, seconds: int):
    return writer.trigger(availableNow=True) if once else writer.trigger(processingTime=f"{seconds} seconds")


def to_table(stream: DataFrame, path: str, checkpoint: str, once: bool = False, seconds: int = CHECKPOINT_SECONDS,
             partition_by: str | None = None) -> StreamingQuery:
    """Append to a parquet table exactly once: the file sink's log and the checkpoint agree."""
    writer = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    return _trigger(writer, once, seconds).start()


def per_batch(stream: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str, once: bool = False,
              seconds: int = CHECKPOINT_SECONDS, mode: str = "append") -> StreamingQuery:
    """Run `step(batch, batch_id)`; the step must write under its batch id to be repeatable."""
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(step)
    return _trigger(writer, once, seconds).start()


def write_branches(batch: DataFrame, split: Callable[[DataFrame], Mapping[str, DataFrame]], root: str, batch_id: int) -> None:
    """Each branch of a batch under its own table, in the batch's own partition; the batch is made once."""
    batch = batch.persist()
    try:
        for name, frame in split(batch).items():
            frame.write.mode("overwrite").parquet(f"{root}/{name}/batch_id={batch_id}")
    finally:
        batch.unpersist()


def finish(query: StreamingQuery, seconds: int | None = None) -> None:
    """Wait for a run over the available data; raises what made the stream fail, or, with a
    limit, when the run does not end in time."""
    if seconds is None:
        query.awaitTermination()
    elif not query.awaitTermination(seconds):
        query.stop()
        raise TimeoutError(f"stream {query.id} did not end within {seconds} s")
