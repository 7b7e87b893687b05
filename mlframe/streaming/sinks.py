"""Streaming sinks and triggers (S12, T1, T2, T4 writer)."""

from __future__ import annotations

import time
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def start_append(df: DataFrame, path: str, checkpoint: str, trigger: str = "available_now",
                 fmt: str = "parquet", partition_by=None, name: str | None = None) -> StreamingQuery:
    """Checkpointed append of a stream to a table folder. File sinks
    commit through a metadata log, so a restart from the same checkpoint
    never duplicates rows."""
    w = df.writeStream.format(fmt).option("checkpointLocation", checkpoint).outputMode("append")
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    if name:
        w = w.queryName(name)
    w = _trigger(w, trigger)
    return w.start(path)


def _trigger(w, trigger):
    if trigger == "available_now":
        return w.trigger(availableNow=True)
    if trigger == "once":
        return w.trigger(once=True)
    return w.trigger(processingTime=trigger)


def drain(query: StreamingQuery, timeout: float | None = None) -> StreamingQuery:
    """Wait until an ``availableNow`` query has processed everything."""
    query.awaitTermination(timeout)
    if query.exception():
        raise query.exception()
    return query


def run_for(query: StreamingQuery, seconds: float) -> StreamingQuery:
    """Let a ``processingTime`` query run for a bounded time, then stop."""
    deadline = time.time() + seconds
    while time.time() < deadline and query.isActive:
        time.sleep(min(0.5, max(0.0, deadline - time.time())))
    query.stop()
    return query


def for_each_batch(df: DataFrame, fn, checkpoint: str, trigger: str = "available_now",
                   name: str | None = None, output_mode: str = "append") -> StreamingQuery:
    """Run ``fn(batch_df, epoch_id)`` per micro-batch. ``fn`` must be
    idempotent per epoch (e.g. overwrite ``.../epoch=<id>``) because a batch
    is replayed after a failure."""
    w = df.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint).outputMode(output_mode)
    if name:
        w = w.queryName(name)
    return _trigger(w, trigger).start()


def epoch_writer(path: str, fmt: str = "parquet"):
    """foreachBatch body writing each epoch to its own folder with overwrite:
    a replayed epoch replaces its own output, so the sink is exactly-once."""
    def write(batch: DataFrame, epoch_id: int):
        batch.write.mode("overwrite").format(fmt).save(f"{path}/epoch={epoch_id:08d}")
    return write


#: State in RocksDB, and no batches without data: processing-time state would ask for one after the other, and a drain never end.
KEYED_STATE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
               "spark.sql.streaming.noDataMicroBatches.enabled": "false"}


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Queries started inside keep their state in RocksDB (on the executors' disks, checkpointed to the shared folder);
    keyed state with time to live needs it. The session's settings come back afterwards; a started query keeps its own."""
    before = {k: spark.conf.get(k, None) for k in KEYED_STATE}
    for k, v in KEYED_STATE.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
