"""Progress of streaming queries as a table."""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

PROGRESS = ("query_id string, run_id string, name string, batch_id long, started_at timestamp, n_input_rows long, watermark timestamp, "
            "state_rows long, state_bytes long, duration_ms long")


class ProgressTable(StreamingQueryListener):
    """Appends one row per micro-batch of the watched queries to a table.

    Register it with ``spark.streams.addListener`` (or use :func:`logged`).
    Progress arrives on the listener's thread and is only kept there; the rows
    (one per batch) are written by :meth:`flush`, outside of it. A batch that
    reports twice is one row when read back.
    """

    def __init__(self, spark: SparkSession, path: str, names=None):
        self.spark, self.path, self.names = spark, path, set(names) if names else None
        self.rows: list[tuple] = []
        self.ended: set[str] = set()
        self.changed = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = json.loads(event.progress.json)
        if self.names and p.get("name") not in self.names:
            return
        state = p.get("stateOperators") or []
        row = (p["id"], p["runId"], p.get("name"), p["batchId"], p["timestamp"], p["numInputRows"], (p.get("eventTime") or {}).get("watermark"),
               sum(s["numRowsTotal"] for s in state), sum(s["memoryUsedBytes"] for s in state), p["batchDuration"])
        with self.changed:
            self.rows.append(row)

    def onQueryTerminated(self, event) -> None:
        with self.changed:
            self.ended.add(str(event.runId))
            self.changed.notify_all()

    def wait_for(self, query: StreamingQuery, timeout: float = 30.0) -> bool:
        """Whether all progress of an ended query has arrived; events come in order, its end last."""
        with self.changed:
            return self.changed.wait_for(lambda: str(query.runId) in self.ended, timeout)

    def flush(self) -> None:
        """Append the rows that have gathered."""
        with self.changed:
            rows, self.rows = self.rows, []
        if not rows:
            return
        raw = PROGRESS.replace("started_at timestamp", "started_at string").replace("watermark timestamp", "watermark string")
        df = self.spark.createDataFrame(rows, raw)
        df.withColumns({c: F.to_timestamp(c) for c in ("started_at", "watermark")}).coalesce(1).write.mode("append").parquet(self.path)


def logged(spark: SparkSession, path: str, run) -> StreamingQuery:
    """Run ``run()`` (it starts a query, waits for its end and returns it) and append its progress to ``path``."""
    listener = ProgressTable(spark, path)
    spark.streams.addListener(listener)
    try:
        query = run()
        listener.wait_for(query)
    finally:
        spark.streams.removeListener(listener)
    listener.flush()
    return query


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """The newest report of every batch of every run."""
    return spark.read.schema(PROGRESS).parquet(path).dropDuplicates(["run_id", "batch_id"])
