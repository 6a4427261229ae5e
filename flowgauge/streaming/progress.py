"""A ledger of what a stream itself reports: one row per micro-batch with its latency.

`watched` lets a stream observe when its rows were received, in the same pass that processes
them. `BatchLedger` listens to the stream's progress and writes a ledger part per batch:
rows, first and last receipt, when the batch was done, and the time between. No row is read
again for it.
"""

from __future__ import annotations

import datetime as dt
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from flowgauge import fixed
from flowgauge.sources.buckets import children
from flowgauge.sources.sinks import log_batch

METRIC = "receipt"
BATCH = (
    "query_id string, run_id string, batch long, rows long, first_received timestamp, last_received timestamp, "
    "started_at timestamp, dispatched_at timestamp, latency_seconds double, latency_sla_passed boolean"
)


def watched(stream: DataFrame, received: str = "ingestion_timestamp") -> DataFrame:
    """The stream with its receipt times observed."""
    at = F.unix_micros(received)
    return stream.observe(METRIC, F.count(F.lit(1)).alias("rows"), F.min(at).alias("first"), F.max(at).alias("last"))


def moment(micros: int | None) -> dt.datetime | None:
    return None if micros is None else dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(microseconds=micros)


class BatchLedger(StreamingQueryListener):
    """Writes the ledger of the queries named; a batch that is reported again overwrites its part.

    The latency runs from the first receipt to the end of the batch; a batch without rows has none.
    """

    def __init__(self, spark: SparkSession, path: str, names: tuple[str, ...] = ()):
        self.spark, self.path, self.names = spark, path, names

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        seen = progress.observedMetrics.get(METRIC)
        if seen is None or (self.names and progress.name not in self.names):
            return
        started = dt.datetime.fromisoformat(progress.timestamp)
        done = started + dt.timedelta(milliseconds=progress.durationMs.get("triggerExecution", 0))
        first, last = moment(seen["first"]), moment(seen["last"])
        latency = (done - first).total_seconds() if first else None
        passed = None if latency is None else latency < float(fixed.LATENCY_GATE_SECONDS)
        row = (str(progress.id), str(progress.runId), progress.batchId, seen["rows"], first, last, started, done, latency, passed)
        log_batch(self.spark.createDataFrame([row], BATCH).coalesce(1), self.path, progress.batchId)


def run_watched(query: StreamingQuery, ledger: BatchLedger, patience: float = 30.0) -> int:
    """Wait for a query that ends by itself and for the ledger of its batches; returns how many these are.

    Progress is reported after a batch, so the last parts may come after the query's end.
    """
    query.awaitTermination()
    batches = {p.batchId for p in query.recentProgress if METRIC in p.observedMetrics}
    until = time.monotonic() + patience
    while time.monotonic() < until:
        parts = {int(n.removeprefix("batch_id=")) for n in children(ledger.spark, ledger.path) if n.startswith("batch_id=")}
        if all(b in parts and "_SUCCESS" in children(ledger.spark, f"{ledger.path}/batch_id={b}") for b in batches):
            break
        time.sleep(0.1)
    return len(batches)
