"""Streaming dedup with expiry: a key is published once per set of published keys.

The source system keeps one set of published keys a day. The set opens with its
first add and expires as a whole EXPIRY_SECONDS later, however many adds follow;
the next add opens another, and a new day (UTC) has a set of its own. Times are
arrival times (the broker's or the collector's clock, a column of the source) in
milliseconds, the resolution of that store. The posting's own event time plays no
part, there is no watermark, and so a key that was not seen is never lost.

Where the sets lie depends on the arrivals' times alone, not on their keys, so a
micro-batch goes in two steps:

1. Its distinct milliseconds, at most 86.4 million a day whatever the rows, pass
   once in order, a stream per day; a set opens where none is open. Open sets of
   earlier batches are merged into that order. The sets are a table of a row each.
2. Each arrival joins the set that holds its time (an equality join on the
   minutes a set touches), rows reduce to the first arrival per (set, key), and what
   the accepted keys of those sets lack is accepted.

Accepted keys are folders by hour of set start, then by run and batch: a batch
reads the hours of its own sets only (`PartitionFilters`), a replayed batch
replaces its own folders and does not see them, and a stream with a new or lost
checkpoint is a new run, which overwrites nothing and continues the open sets.
`expire_sets` drops whole hours. One writer at a time.

An arrival that comes late, in a batch after its time, joins the set that held
its time; where there was none it opens one, which ends before the next. For
arrivals in order the result does not depend on how they are cut into batches.
Arrivals without a time are in no set and are dropped.
"""

from __future__ import annotations

import datetime as dt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import with_dedup_key
from ..operators.lake import file_system, numbered_folders, read_or_empty, run_of

EXPIRY_SECONDS = 60
MANY_SETS = 100_000      # up to so many sets of a batch are broadcast
DAY_MS, HOUR_MS, MINUTE_MS = 86_400_000, 3_600_000, 60_000
ACCEPTED = ("dedup_key string, set_start timestamp, arrived_at timestamp, job_id string, "
            "set_hour int, run int, batch_id long")
SETS = "starts long, set_hour int, run int, batch_id long"  # milliseconds
FOLDERS = ("set_hour", "run", "batch_id")


def millisecond(arrived: Column) -> Column:
    return F.floor(F.unix_micros(arrived) / 1000)


def set_hour(starts: Column) -> Column:
    """Folder of a set: the hour it starts in, counted from 1970."""
    return F.floor(starts / HOUR_MS).cast("int")


def opened_sets(ticks: DataFrame, known: DataFrame, seconds: int = EXPIRY_SECONDS) -> DataFrame:
    """(starts, ends, fresh): the sets that hold the milliseconds `ticks` (at), with the `known` ones (starts).

    One ordered pass per day that holds the current set only.
    """
    span = seconds * 1000

    def run(batches):
        current = None  # [starts, ends, fresh]
        for batch in batches:
            out = []
            times, old = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            olds, i = np.flatnonzero(old), 0
            while i < len(times):
                at = int(times[i])
                if not old[i] and current and current[0] <= at < current[1]:
                    # All that lies in the current set is passed over, up to the next known one.
                    later = np.searchsorted(times, current[1])
                    next_old = np.searchsorted(olds, i)
                    i = min(later, olds[next_old]) if next_old < len(olds) else later
                    continue
                if current:
                    out.append((current[0], min(current[1], at), current[2]))
                current = [at, min(at + span, (at // DAY_MS + 1) * DAY_MS), not old[i]]
                i += 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["starts", "ends", "fresh"])
        if current:
            yield pa.RecordBatch.from_arrays([pa.array([c]) for c in current], names=["starts", "ends", "fresh"])

    rows = known.select(F.col("starts").alias("at"), F.lit(True).alias("old")).unionByName(
        ticks.select("at", F.lit(False).alias("old")))
    by_day = rows.withColumn("day", F.floor(F.col("at") / DAY_MS)).repartition("day") \
        .sortWithinPartitions("day", "at", F.col("old").desc())
    return by_day.select("at", "old").mapInArrow(run, "starts long, ends long, fresh boolean")


def in_sets(rows: DataFrame, sets: DataFrame, number: int) -> DataFrame:
    """`rows` (with `at`) with the `starts` of the set that holds each, out of `number` sets."""
    minutes = F.sequence(F.floor(F.col("starts") / MINUTE_MS), F.floor((F.col("ends") - 1) / MINUTE_MS))
    held = sets.select("starts", "ends", F.explode(minutes).alias("minute"))
    held = F.broadcast(held) if number <= MANY_SETS else held
    return rows.withColumn("minute", F.floor(F.col("at") / MINUTE_MS)).join(held, "minute") \
        .filter((F.col("at") >= F.col("starts")) & (F.col("at") < F.col("ends"))).drop("minute", "ends")


def first_arrivals(rows: DataFrame) -> DataFrame:
    """(dedup_key, set_start, arrived_at, job_id): the first arrival per set (`starts`) and key.

    The reduction is a partial aggregate: no key ever meets in one task as rows.
    """
    return (rows.groupBy("starts", "dedup_key").agg(F.min(F.struct("arrived_at", "job_id")).alias("first"))
            .select("dedup_key", F.timestamp_millis("starts").alias("set_start"), "first.*",
                    set_hour(F.col("starts")).alias("set_hour")))


def accepted_keys(spark: SparkSession, path: str) -> DataFrame:
    """What the streams have accepted so far."""
    return read_or_empty(spark, f"{path}/keys", ACCEPTED)


def accepted_sets(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, f"{path}/sets", SETS)


def other_batches(run: int, batch_id: int) -> Column:
    """All but one batch: a replayed batch must not see itself."""
    return (F.col("run") != run) | (F.col("batch_id") != batch_id)


def accept_batch(batch: DataFrame, path: str, run: int, batch_id: int, seconds: int = EXPIRY_SECONDS) -> None:
    """Write what one micro-batch adds to the accepted keys and sets under `path`."""
    spark = batch.sparkSession
    rows = batch.filter(F.col("arrived_at").isNotNull()).withColumn("at", millisecond(F.col("arrived_at")))
    span = rows.agg(F.min("at"), F.max("at")).first()
    if span[0] is None:
        return
    # Only sets near the batch's times matter: those that may still be open, to the last arrival.
    first, last = span[0] - seconds * 1000, span[1] + seconds * 1000
    known = accepted_sets(spark, path).filter(
        F.col("set_hour").between(first // HOUR_MS, last // HOUR_MS) & F.col("starts").between(first, last)
        & other_batches(run, batch_id))
    ticks = rows.select("at").distinct()
    opened_sets(ticks, known, seconds).write.mode("overwrite").parquet(f"{path}/opened")
    sets = spark.read.schema("starts long, ends long, fresh boolean").parquet(f"{path}/opened")
    hour = set_hour(F.col("starts"))
    number, *hours = sets.agg(F.count(F.lit(1)), F.min(hour), F.max(hour)).first()
    keyed = rows if "dedup_key" in rows.columns else with_dedup_key(rows, ts=None)
    found = first_arrivals(in_sets(keyed, sets, number))
    before = before_batch(spark, path, run, batch_id, *hours)
    new = found.join(before, ["set_hour", "set_start", "dedup_key"], "left_anti")
    fresh = sets.filter("fresh").select("starts", hour.alias("set_hour"))
    # Sets first: a batch that dies in between leaves no accepted key in a set nobody knows.
    # Rows meet by hour, so that a file holds as much of an hour as adaptive execution lets a
    # task have: hours and tasks both grow with the batch, and a file of each would be as many as both multiplied.
    for name, table in (("sets", fresh), ("keys", new.hint("rebalance", "set_hour"))):
        (table.withColumns({"run": F.lit(run), "batch_id": F.lit(batch_id).cast("long")})
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*FOLDERS)
         .parquet(f"{path}/{name}"))


def before_batch(spark: SparkSession, path: str, run: int, batch_id: int, first_hour: int, last_hour: int) -> DataFrame:
    """(set_hour, set_start, dedup_key) accepted by other batches in these hours; only their folders are read."""
    return (accepted_keys(spark, path).filter(F.col("set_hour").between(first_hour, last_hour)
                                              & other_batches(run, batch_id))
            .select("set_hour", "set_start", "dedup_key"))


def expire_sets(spark: SparkSession, path: str, before: dt.datetime) -> list[int]:
    """Drop the sets, and their accepted keys, of whole hours before `before`; returns the hours dropped."""
    oldest = int(before.timestamp() * 1000) // HOUR_MS
    dropped = set()
    for name in ("keys", "sets"):
        files, make = file_system(spark, path)
        for hour in numbered_folders(spark, f"{path}/{name}", "set_hour"):
            if hour < oldest:
                files.delete(make(f"{path}/{name}/set_hour={hour}"), True)
                dropped.add(hour)
    return sorted(dropped)


def stream_dedup(rows: DataFrame, accepted_path: str, checkpoint: str,
                 seconds: int = EXPIRY_SECONDS) -> DataFrame:
    """Drain streaming `rows` (with `arrived_at`) and return the accepted keys."""
    def accept(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stream_id = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        accept_batch(batch, accepted_path, run_of(spark, accepted_path, stream_id), batch_id, seconds)

    query = (rows.writeStream.foreachBatch(accept).option("checkpointLocation", checkpoint)
             .outputMode("append").trigger(availableNow=True).start())
    try:
        query.awaitTermination()
    finally:
        query.stop()
    return accepted_keys(rows.sparkSession, accepted_path)
