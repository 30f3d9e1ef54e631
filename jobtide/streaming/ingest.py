"""Streaming ingest: message stream -> parsed lake rows -> per-batch lake folders.

readStream (kafka by config; a folder of JSON lines in tests) -> the same
parse as batch -> foreachBatch writing `<lake>/run=R/batch_id=N` in overwrite mode.
The checkpoint records offsets, so a restarted run resumes where it stopped,
and a replayed batch rewrites its own folder instead of adding rows twice.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.ingest import all_records, count_columns, parse_records
from ..operators.lake import run_of, write_lake_batch
from ..sources.connectors import read_stream
from .progress import OBSERVED, ProgressTable

log = logging.getLogger(__name__)


def parsed_stream(spark: SparkSession, fmt: str, options: Mapping[str, str] | None = None,
                  path: str | None = None, strict_seconds: bool = False) -> DataFrame:
    """Streaming DF of lake rows from a source whose rows carry a `value`."""
    raw = read_stream(spark, fmt, options, path)
    return parse_records(raw, "value", strict_seconds)


def lake_batch_writer(lake_path: str, counts: list | None = None, progress: ProgressTable | None = None):
    """foreachBatch function: write the micro-batch into its own lake folder, and the
    reports on earlier ones into the progress table.

    The folder is named after the stream's run in this lake and the batch. The
    batch arrives as parsed rows, rejects included; their counts are appended
    to `counts` (driver side), a row of numbers per batch.
    """
    def write(batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        stream_id = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        if progress is not None:
            # The engine counts each pass over its source, and a batch with quarantined rows
            # takes two: with reports asked for, the parsed rows are kept for the second.
            progress.write(stream_id)
            batch_df = batch_df.persist(StorageLevel.DISK_ONLY)
        seen = Observation()
        rows = batch_df.observe(seen, *count_columns()).filter(F.col("job_id").isNotNull())
        stored = write_lake_batch(rows, batch_id, lake_path, run_of(spark, lake_path, stream_id))
        # A batch of rejects only has no observed counts (see `write_lake_batch`).
        found = seen.get if stored["written"] else batch_df.agg(*count_columns()).first().asDict()
        if progress is not None:
            batch_df.unpersist()
        if counts is not None:
            counts.append({"batch_id": batch_id, **found})
        log.info("lake batch %s written: %s", batch_id, found)
    return write


def stream_ingest(spark: SparkSession, fmt: str, options: Mapping[str, str] | None,
                  lake_path: str, checkpoint: str, path: str | None = None,
                  processing_time: str | None = None, available_now: bool = True,
                  timeout_s: float | None = None, strict_seconds: bool = False,
                  progress_path: str | None = None) -> list[dict]:
    """Run the ingest stream; returns per batch what was received, rejected,
    quarantined and written. With `progress_path` the engine's reports on the
    batches, with the same counts observed on the stream, go to a table there.

    available_now=True drains what is there and ends (the bounded run);
    otherwise it triggers every `processing_time` (e.g. "5 seconds") until
    `timeout_s`. The query is always stopped on the way out.
    """
    counts: list[dict] = []
    rows = all_records(read_stream(spark, fmt, options, path), "value", strict_seconds)
    progress = ProgressTable(spark, progress_path) if progress_path else None
    if progress is not None:
        rows = rows.observe(OBSERVED, *count_columns())
        spark.streams.addListener(progress)
    writer = (rows.writeStream
              .foreachBatch(lake_batch_writer(lake_path, counts, progress))
              .option("checkpointLocation", checkpoint)
              .outputMode("append"))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    query = writer.start()
    try:
        query.awaitTermination(timeout_s) if timeout_s else query.awaitTermination()
    finally:
        query.stop()
        if progress is not None:
            progress.finish(query)
            spark.streams.removeListener(progress)
    if query.exception() is not None:
        raise query.exception()
    return counts
