"""Lake table: idempotent per-batch writes, storage layout, current view.

Layout: `<lake>/run=R/batch_id=N/source=S/scraped_month=yyyy-MM/*.parquet`.
- One folder per stream and micro-batch, written in overwrite mode: a replayed
  batch replaces its own folder instead of appending twice. A stream is known
  by the id in its checkpoint; a stream the lake has not met (a new or a lost
  checkpoint, whose batches count from 0 again) gets the next run number, so
  it never overwrites another's history and its rows are the later version.
- Inside a batch, adaptive execution rebalances rows by (source, month): large
  groups are split over tasks, small ones meet in one file. Files are sorted,
  newest first, then job id, so that parquet min/max statistics let a `> mark`
  filter skip row groups. `source` / `scraped_month` folders let scans prune;
  month folders keep the file count bounded (days would multiply it by ~30).
- The current view is last-write-wins per key, as a sort-based aggregate with a
  partial step.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import LAKE_KEY, LAKE_SCHEMA
from .ingest import complete_key, split_quarantine

# Partition folders first (ascending, as the file writer needs), then the
# clustering order inside each file.
def storage_order() -> list:
    return [F.col("source").asc(), F.col("scraped_month").asc(),
            F.col("scraped_at").desc(), F.col("job_id").asc()]


PARTITION_COLUMNS = ["source", "scraped_month"]
VERSION = ("run", "batch_id")


def month_of(col) -> "F.Column":
    """`yyyy-MM` text of a timestamp (the lake's time partition)."""
    return F.date_format(col, "yyyy-MM")


def with_scraped_month(df: DataFrame) -> DataFrame:
    return df.withColumn("scraped_month", month_of(F.col("scraped_at")))


def lake_layout(df: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Range-partition on the storage order and sort within partitions."""
    df = with_scraped_month(df)
    if num_partitions:
        df = df.repartitionByRange(num_partitions, *storage_order())
    else:
        df = df.repartitionByRange(*storage_order())
    return df.sortWithinPartitions(*storage_order())


def write_lake_batch(df: DataFrame, batch_id: int, lake_path: str, run: int = 0) -> dict:
    """Write one batch into its own folder (overwrite = idempotent replay).

    Rows without a complete key (an empty source counts as none) go to
    `<lake>/_quarantine/run=R/batch_id=N`, which lake scans skip. They are
    counted during the write; only if there are any is the batch read again.
    Where no row is left to write, adaptive execution drops the plan under the
    empty shuffle, observed counts included, and the batch is counted by itself.
    Returns the counts `received`, `quarantined` and `written`.
    """
    seen, columns = Observation(), [F.count(F.lit(1)).alias("received"),
                                    F.count_if(~complete_key()).alias("quarantined")]
    folder = f"{lake_path}/run={run}/batch_id={batch_id}"
    placed = (with_scraped_month(df.observe(seen, *columns).filter(complete_key()))
              .hint("rebalance", *PARTITION_COLUMNS).sortWithinPartitions(*storage_order()))
    placed.write.mode("overwrite").partitionBy(*PARTITION_COLUMNS).parquet(folder)
    files, make = file_system(df.sparkSession, folder)
    any_row = any(s.isDirectory() for s in files.listStatus(make(folder)))
    counts = dict(seen.get) if any_row else df.agg(*columns).first().asDict()
    if counts["quarantined"]:
        split_quarantine(df)[1].write.mode("overwrite") \
            .parquet(f"{lake_path}/_quarantine/run={run}/batch_id={batch_id}")
    return {**counts, "written": counts["received"] - counts["quarantined"]}


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType | str,
                  base: str | None = None) -> DataFrame:
    """The parquet files at `path` with a declared schema; none yet reads as empty."""
    try:
        return spark.read.schema(schema).option("basePath", base or path).parquet(path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" not in str(exc) and "does not exist" not in str(exc):
            raise
        return spark.createDataFrame([], schema)


def run_of(spark: SparkSession, lake_path: str, stream_id: str) -> int:
    """The run number of a stream in this lake; an unknown stream gets the next one.

    The table has a row per stream. A lake has one writer at a time.
    """
    path, schema = f"{lake_path}/_runs", "stream_id string, run int"
    spark.createDataFrame([], schema).write.mode("ignore").parquet(path)
    known = {r["stream_id"]: r["run"] for r in spark.read.schema(schema).parquet(path).collect()}
    if stream_id not in known:
        known[stream_id] = max(known.values(), default=-1) + 1
        spark.createDataFrame([(stream_id, known[stream_id])], schema) \
            .coalesce(1).write.mode("append").parquet(path)
    return known[stream_id]


# Partition folders come back as declared: a source "007" stays text.
STORED_SCHEMA = T.StructType(
    [f for f in LAKE_SCHEMA.fields if f.name not in PARTITION_COLUMNS]
    + [T.StructField("run", T.IntegerType()), T.StructField("batch_id", T.LongType()),
       T.StructField("source", T.StringType()), T.StructField("scraped_month", T.StringType())])


def read_lake(spark: SparkSession, lake_path: str) -> DataFrame:
    """All batches of the lake, with run / batch_id / source / scraped_month columns.

    A lake with no batch yet reads as empty (same columns), not as an error.
    """
    return read_or_empty(spark, f"{lake_path}/run=*/batch_id=*", STORED_SCHEMA, base=lake_path)


def lake_current(df: DataFrame, key: Sequence[str] = tuple(LAKE_KEY),
                 version: Sequence[str] = VERSION) -> DataFrame:
    """Last write wins per key: the row of the highest `version`, compared in order.

    An aggregate of `max(struct(version, ...))`: partial per map task, so a
    hot key never meets in one task as rows. The buffer is a struct, so Spark
    sorts instead of hashing: select the columns that are needed first. Ties
    within one version are broken by the remaining columns.
    """
    key, order = list(key), [c for c in version if c in df.columns]
    rest = [c for c in df.columns if c not in key and c not in order]
    newest = F.max(F.struct(*order, *rest)).alias("_w")
    return df.groupBy(*key).agg(newest).select(
        *key, *(F.col(f"_w.{c}").alias(c) for c in [*order, *rest]))


def after(run: int, batch_id: int) -> Column:
    """Rows of batches later than this one; both are folders, so the scan prunes."""
    return (F.col("run") > run) | ((F.col("run") == run) & (F.col("batch_id") > batch_id))


def file_system(spark: SparkSession, path: str):
    """The file system of `path`, and the function that names a place in it."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark._jsc.hadoopConfiguration()), make


def numbered_folders(spark: SparkSession, path: str, name: str) -> list[int]:
    """N of the folders `name=N` in `path`, falling; none if there is no such path."""
    files, make = file_system(spark, path)
    found = [s.getPath().getName() for s in files.listStatus(make(path))] if files.exists(make(path)) else []
    return sorted((int(f.removeprefix(f"{name}=")) for f in found if f.startswith(f"{name}=")), reverse=True)


def latest_batch(spark: SparkSession, lake_path: str) -> tuple[int, int]:
    """(run, batch_id) of the newest finished batch; (-1, -1) for an empty lake.

    Only folders are listed, newest first: no file is opened.
    """
    files, make = file_system(spark, lake_path)
    for run in numbered_folders(spark, lake_path, "run"):
        for batch in numbered_folders(spark, f"{lake_path}/run={run}", "batch_id"):
            if files.exists(make(f"{lake_path}/run={run}/batch_id={batch}/_SUCCESS")):
                return run, batch
    return -1, -1


def snapshot_current(spark: SparkSession, lake_path: str, snapshot_path: str,
                     upto: tuple[int, int], snapshot: str | None = None,
                     since: tuple[int, int] | None = None) -> str:
    """Compact: write the current view of the batches up to `upto` as a table.

    With an earlier `snapshot` and the batch it goes to (`since`), only later
    batches are read. Returns the snapshot folder. Old batch folders can be
    expired by retention without changing any result.
    """
    current = read_current(spark, lake_path, snapshot, since).filter(~after(*upto))
    out = f"{snapshot_path}/run={upto[0]}-batch={upto[1]}"
    (with_scraped_month(current).hint("rebalance", *PARTITION_COLUMNS)
     .sortWithinPartitions(*storage_order())
     .write.mode("overwrite").partitionBy(*PARTITION_COLUMNS).parquet(out))
    return out


def read_current(spark: SparkSession, lake_path: str, snapshot: str | None = None,
                 upto: tuple[int, int] | None = None) -> DataFrame:
    """Current view = last write wins over (snapshot + batches after it).

    The filter on run and batch prunes the older batch folders.
    """
    batches = read_lake(spark, lake_path).drop("scraped_month")
    if snapshot is None:
        return lake_current(batches)
    base = spark.read.schema(STORED_SCHEMA).parquet(snapshot).drop("scraped_month")
    return lake_current(base.unionByName(batches.filter(after(*upto))))
