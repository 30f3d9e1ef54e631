"""Write-side upsert: a base table bucketed on the lake key, batches merged into it bucket by bucket.

The source system's store resolves an upsert when it writes. Here the current
rows are a Parquet table bucketed and sorted on the key. A merge joins a batch to
it: the base is read by buckets, without an exchange, and only the batch is
shuffled, to the same number of buckets; the join's tasks are the new buckets. Reading the current view is a plain scan.

A merge writes a new folder, then a row that names it as the current version
(copy on write): readers of the old version are not disturbed, and a merge that
dies before its row is repeated over its own folder. Rows carry the (run,
batch) they come from and the later one wins, so merging a batch twice changes
nothing. Versions older than the current one can be deleted by retention. One
writer at a time.

Bucket ids live in file names and a table's catalog entry. The entry is made for
each read from the written rows, so any session can read the base; files are
never the catalog's own.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import LAKE_COLUMNS, LAKE_KEY, LAKE_SCHEMA
from .lake import VERSION, after, lake_current, read_lake, read_or_empty

BUCKETS = 16  # of a new base; take the base's size over some 200 MB at scale
BASE_SCHEMA = T.StructType([*LAKE_SCHEMA.fields, T.StructField("run", T.IntegerType()), T.StructField("batch_id", T.LongType())])
MERGED = "version int, run int, batch_id long, buckets int"


def _entry(name: str, schema: str, buckets: int, folder: str, key: Sequence[str]) -> str:
    columns = ", ".join(f"`{k}`" for k in key)
    return (f"CREATE TABLE {name} ({schema}) USING parquet CLUSTERED BY ({columns}) SORTED BY ({columns}) "
            f"INTO {buckets} BUCKETS LOCATION '{folder}'")


def merged_state(spark: SparkSession, base_path: str) -> dict | None:
    """The current version of the base, the last batch it holds and its buckets; None without any."""
    rows = read_or_empty(spark, f"{base_path}/_merged", MERGED)
    newest = rows.agg(F.max(F.struct("version", "run", "batch_id", "buckets")).alias("v")).first()["v"]
    return newest.asDict() if newest else None


def read_merged(spark: SparkSession, base_path: str, key: Sequence[str] = tuple(LAKE_KEY),
                schema: T.StructType = BASE_SCHEMA) -> DataFrame:
    """The current rows, with their (run, batch_id), as a bucketed scan."""
    state = merged_state(spark, base_path)
    if state is None:
        return spark.createDataFrame([], schema)
    name = f"jobtide_base_{uuid.uuid4().hex}"
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(_entry(name, schema, state["buckets"], f"{base_path}/version={state['version']}", key))
    try:
        # The plan keeps files and buckets; an external table's entry can go at once.
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")


def upserted(base: DataFrame, batch: DataFrame, buckets: int, key: Sequence[str] = tuple(LAKE_KEY)) -> DataFrame:
    """`base` with the rows of `batch` that are new or not older; both with (run, batch_id).

    `base` has one row per key. `batch` is reduced, partial aggregates first, and what is left
    goes to `buckets` partitions.
    """
    key, columns = list(key), base.columns
    last = lake_current(batch.select(*columns), key).select(*columns).repartition(buckets, *key)
    old, new = base.alias("old"), last.alias("new")
    joined = old.join(new, [F.col(f"old.{k}") == F.col(f"new.{k}") for k in key], "full_outer")
    version = {side: F.struct(*(F.col(f"{side}.{v}") for v in VERSION)) for side in ("old", "new")}
    takes_new = F.col("old.run").isNull() | (F.col("new.run").isNotNull() & (version["new"] >= version["old"]))
    return joined.select(*(F.coalesce(F.col(f"new.{k}"), F.col(f"old.{k}")).alias(k) if k in key else
                           F.when(takes_new, F.col(f"new.{k}")).otherwise(F.col(f"old.{k}")).alias(k)
                           for k in columns))


def merge_batch(spark: SparkSession, base_path: str, batch: DataFrame, upto: tuple[int, int],
                buckets: int | None = None, key: Sequence[str] = tuple(LAKE_KEY)) -> int:
    """Merge `batch` (key complete, with run and batch_id) into the base; returns the new version.

    `buckets` counts for a new base only: a base keeps its number.
    """
    state = merged_state(spark, base_path)
    version, buckets = (state["version"] + 1, state["buckets"]) if state else (0, buckets or BUCKETS)
    rows = upserted(read_merged(spark, base_path, key, batch.schema), batch, buckets, key)
    name = f"jobtide_base_{uuid.uuid4().hex}"
    (rows.write.format("parquet").mode("overwrite").bucketBy(buckets, *key).sortBy(*key)
     .option("path", f"{base_path}/version={version}").saveAsTable(name))
    spark.sql(f"DROP TABLE {name}")
    spark.createDataFrame([(version, *upto, buckets)], MERGED).coalesce(1).write.mode("append").parquet(f"{base_path}/_merged")
    return version


def merge_lake(spark: SparkSession, lake_path: str, base_path: str, upto: tuple[int, int], buckets: int | None = None) -> int | None:
    """Merge the lake's batches after the last merged one, up to `upto`; None if there are none.

    The filter on run and batch is one of folders: merged batches are not read again.
    """
    state = merged_state(spark, base_path)
    since = (state["run"], state["batch_id"]) if state else (-1, -1)
    if tuple(upto) <= since:
        return None
    batches = read_lake(spark, lake_path).filter(after(*since) & ~after(*upto)).select(*LAKE_COLUMNS, *VERSION)
    return merge_batch(spark, base_path, batches, upto, buckets)
