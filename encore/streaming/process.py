"""Micro-batch execution.

Per-batch logic calls the same DataFrame operators as the batch plans. The
sink writes each non-empty batch to ``<out>/batch_id=<id>`` with overwrite,
so a batch replayed after a failure replaces its own output (exactly once
at the directory level). Recovery is from the checkpoint location.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame


def batch_dir_writer(out_dir: str, transform: Callable[[DataFrame, int], DataFrame]):
    """foreachBatch function: skip empty batches, transform, write ``batch_id=<id>``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        # the batch is read by the emptiness check and several times by the
        # transform: cache it once (spills to disk), release it after the write
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if batch.isEmpty():
                return
            (transform(batch, batch_id).write.mode("overwrite")
             .parquet(f"{out_dir}/batch_id={batch_id}"))
        finally:
            batch.unpersist()
    return write


def run_stream(stream: DataFrame, foreach_batch, checkpoint: str,
               available_now: bool = True, processing_time: str = "10 seconds",
               timeout: float | None = None):
    """Start with a checkpoint and wait.

    ``available_now=True`` processes what is there and stops (tests, backfills);
    otherwise a processing-time trigger runs until ``timeout`` seconds have
    passed (then the query is stopped) or forever when ``timeout`` is None.
    """
    writer = (stream.writeStream.foreachBatch(foreach_batch)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now \
        else writer.trigger(processingTime=processing_time)
    query = writer.start()
    if available_now:
        query.awaitTermination()
    elif timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
    if query.exception() is not None:
        raise query.exception()
    return query
