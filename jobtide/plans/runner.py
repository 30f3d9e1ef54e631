"""The whole run, in the source system's order, as Spark jobs.

collect -> seen check (per-day key set, anti join) -> commit of messages and
seen keys under one publish id -> delivery (message files, or Kafka when
configured) -> stream ingest into the lake -> mart load of the lake's new
batches -> rollups.

The seen set of a run is a day's, kept with the messages it stands for (`outbox`). The collectors' 60-second expiry belongs to a stream of arrivals:
`streaming.stream_dedup` has it, for callers that publish continuously.

Every step is restartable: a publish that was committed and not delivered is
delivered by the next run, one that was not committed leaves nothing behind,
delivered messages are read back by a checkpointed stream, each micro-batch
overwrites its own lake folder, and the mart append commits per job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as J
from .. import operators as O
from .. import sources as S
from .. import streaming as ST
from ..schema import MART_COLUMNS, MART_SCHEMA
from ..session import run_dir
from . import outbox


def run_all(spark: SparkSession, records: DataFrame, work: str | None = None, day=None,
            kafka: dict | None = None) -> dict:
    """Run every stage once over collected `records` (wire-record columns).

    `work` is the run's folder on shared storage (default: a new folder under
    spark.checkpoint.dir); reuse it to continue a previous run. `day` scopes
    the seen set (default: today). With `kafka` ({"bootstrap", "topic"}) the
    messages go to Kafka and the stream reads them back from there.
    Returns row counts and the two rollup DataFrames.
    """
    work = work or run_dir(spark, "run")
    topic, box = f"{work}/topic", f"{work}/outbox"
    lake, mart = f"{work}/lake", f"{work}/mart"
    day_col = F.current_date() if day is None else F.lit(day).cast("date")

    # What a run that died has committed and not delivered comes first.
    def deliver():
        if kafka:
            return outbox.send(spark, box, lambda e: S.kafka_publish(e, kafka["bootstrap"], kafka["topic"]))
        return outbox.deliver(spark, box, topic)

    deliver()
    # Seen check and set add: the first record per (day, key) wins; keys
    # already seen today are skipped.
    keyed = records.withColumns({"dedup_key": J.dedup_key("title", "url"), "day": day_col})
    seen = outbox.committed(spark, box).filter(F.col("day") == day_col)
    fresh = O.dedup_batch(O.drop_seen(keyed, seen, keys=["day", "dedup_key"]),
                          keys=["day", "dedup_key"], order=("jobId",), count_col=None)
    n_published = outbox.commit(spark, box, O.publish_envelope(fresh, "dedup_key", "day"))
    deliver()

    # Stream ingest: whatever is new on the topic since the last run.
    if kafka:
        src_fmt, src_opts, src_path = "kafka", S.kafka_source_options(kafka["bootstrap"],
                                                                     kafka["topic"]), None
    else:
        src_fmt, src_opts, src_path = "text", {}, topic
    counts = []
    files, path = O.file_system(spark, topic)
    if kafka or files.exists(path(topic)):
        counts = ST.stream_ingest(spark, src_fmt, src_opts, lake, f"{work}/checkpoints/ingest",
                                  path=src_path)

    n_mart = load_mart(spark, lake, mart, f"{work}/loaded")
    mart_df = O.read_or_empty(spark, mart, MART_SCHEMA)
    return {
        "work": work,
        "published": n_published,
        **{k: sum(c[k] for c in counts) for k in ("received", "rejected", "quarantined")},
        "ingested": sum(c["written"] for c in counts),
        "mart_rows_written": n_mart,
        "location_count": O.location_count(mart_df),
        "category_count": O.category_count(mart_df, clean=False),
    }


def load_mart(spark: SparkSession, lake: str, mart: str, loaded: str) -> int:
    """Append what the lake got since the last load; returns the rows written.

    New is what lies in later batch folders, whatever its time stamp, so a
    posting that arrives late is not passed over, and older folders are not
    read. Postings whose key the mart holds are repeats. `loaded` has a row
    per load; a load that dies before its row is repeated, without repeats.
    """
    last = O.read_or_empty(spark, loaded, "run int, batch_id long") \
        .agg(F.max(F.struct("run", "batch_id")).alias("v")).first()["v"]
    newest = O.latest_batch(spark, lake)
    since = (-1, -1) if last is None else tuple(last)
    if newest == since:
        return 0
    fresh = O.lake_current(O.read_lake(spark, lake).filter(O.after(*since) & ~O.after(*newest))
                           .drop("scraped_month")).drop("run", "batch_id")
    rows = O.mart_clean(fresh)
    # Only the mart's row groups of the fresh rows' times are read.
    span = fresh.agg(F.min("scraped_at").alias("a"), F.max("scraped_at").alias("b")) \
        .select(J.timestamp_text("a"), J.timestamp_text("b")).first()
    held = O.read_or_empty(spark, mart, MART_SCHEMA).select("source", "scraped_at", "job_id") \
        .filter(F.col("scraped_at").between(*span))
    out, seen = O.with_row_count(rows.join(held, ["source", "scraped_at", "job_id"], "left_anti")
                                 .select(*MART_COLUMNS), "mart_rows")
    O.parquet_mart_sink(mart)(out)
    spark.createDataFrame([newest], "run int, batch_id long").coalesce(1).write.mode("append").parquet(loaded)
    return int(seen.get["rows"])


def main(argv: list[str] | None = None) -> dict:
    """Command line: run everything once over the postings view of a table folder.

    python -m jobtide.plans.runner --sf-dir /root/testdata/sf0.01 [--work DIR] [--day YYYY-MM-DD]
        [--kafka-bootstrap HOST:PORT --kafka-topic NAME]
    """
    import argparse
    import json

    from ..session import get_spark

    ap = argparse.ArgumentParser(prog="jobtide.plans.runner")
    ap.add_argument("--sf-dir", required=True)
    ap.add_argument("--work")
    ap.add_argument("--day")
    ap.add_argument("--kafka-bootstrap")
    ap.add_argument("--kafka-topic")
    args = ap.parse_args(argv)
    spark = get_spark("jobtide-run")
    kafka = ({"bootstrap": args.kafka_bootstrap, "topic": args.kafka_topic}
             if args.kafka_bootstrap and args.kafka_topic else None)
    records = S.jobs_as_records(S.jobs(spark, args.sf_dir))
    out = run_all(spark, records, work=args.work, day=args.day,
                  kafka=kafka)
    summary = {k: v for k, v in out.items() if not isinstance(v, DataFrame)}
    for name in ("location_count", "category_count"):  # free text: a row per value, so to files
        summary[name] = f"{out['work']}/{name}"
        out[name].write.mode("overwrite").parquet(summary[name])
    print(json.dumps(summary, ensure_ascii=False))
    return summary


if __name__ == "__main__":
    main()
