"""Diagnostics of a stream as a table: a row per micro-batch, from the engine's progress events.

The engine reports every finished micro-batch: its input rows and rate, how long
it took, its state, how far behind its source it is, and what the query observes
on its rows. A listener turns each report into a row. Rows wait on the driver until the
next micro-batch, or the end, writes them: at most a few, as reports come one
per batch and a batch writes what came before it.

The table has a file per write, in folders by stream and run of it; a batch that
is replayed after a restart is reported again under its new run, so sums over
`last_reports` count it once.
"""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..operators.lake import read_or_empty

PROGRESS = ("batch_id long, reported_at timestamp, input_rows long, rows_per_second double, took_ms long, "
            "source_lag long, state_rows long, state_bytes long, received long, rejected long, quarantined long, "
            "written long, stream string, run string")
OBSERVED = "ingest"                                     # name of the counts the stream observes
COUNTS = ("received", "rejected", "quarantined", "written")
PATIENCE_SECONDS = 30                                   # longest wait for the last report


def source_lag(progress: dict) -> int | None:
    """What the sources still hold, as far as they say: files not yet read, or offsets behind."""
    said = [s.get("metrics") or {} for s in progress.get("sources", [])]
    lags = [int(float(m[k])) for m in said for k in ("numFilesOutstanding", "maxOffsetsBehindLatest") if k in m]
    return sum(lags) if lags else None


def progress_row(progress: dict) -> tuple:
    """A report of the engine as a row of PROGRESS, the time as text."""
    state = progress.get("stateOperators", [])
    seen = progress.get("observedMetrics", {}).get(OBSERVED) or {}
    return (progress["batchId"], progress["timestamp"], progress["numInputRows"],
            float(progress.get("processedRowsPerSecond") or 0.0), progress.get("batchDuration"), source_lag(progress),
            sum(s.get("numRowsTotal", 0) for s in state), sum(s.get("memoryUsedBytes", 0) for s in state),
            *(seen.get(c) for c in COUNTS), progress["id"], progress["runId"])


class ProgressTable(StreamingQueryListener):
    """Keeps the reports of one stream until `write` appends them to the table at `path`."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.waiting: dict[str, list[tuple]] = {}
        self.reported: dict[str, int] = {}

    def onQueryStarted(self, event):
        pass

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass

    def onQueryProgress(self, event):
        progress = json.loads(event.progress.json)
        self.waiting.setdefault(progress["id"], []).append(progress_row(progress))
        self.reported[progress["id"]] = progress["batchId"]

    def write(self, stream: str) -> None:
        """Append the reports of a stream (by its id) that came so far."""
        rows, self.waiting[stream] = self.waiting.get(stream, []), []
        if rows:
            schema = PROGRESS.replace("reported_at timestamp", "reported_at string")
            self.spark.createDataFrame(rows, schema).withColumn("reported_at", F.to_timestamp("reported_at")).coalesce(1) \
                .write.mode("append").partitionBy("stream", "run").parquet(self.path)

    def finish(self, query: StreamingQuery) -> None:
        """Write the rest once the stream's last report is here: events come a little later."""
        last = query.lastProgress
        last = last["batchId"] if last else -1
        until = time.time() + PATIENCE_SECONDS
        while self.reported.get(str(query.id), -1) < last and time.time() < until:
            time.sleep(0.05)
        self.write(str(query.id))


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, path, PROGRESS)


def last_reports(progress: DataFrame) -> DataFrame:
    """One row per stream and batch with input: the last report. A stream has a row per batch, few."""
    newest = Window.partitionBy("stream", "batch_id").orderBy(F.desc("reported_at"), F.desc("run"))
    return progress.filter("input_rows > 0").withColumn("rank", F.row_number().over(newest)) \
        .filter("rank = 1").drop("rank")
