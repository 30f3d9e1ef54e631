"""Readers and writers chosen by format and options.

Connector format, options, credentials and paths are parameters; nothing is
hard-coded. Kafka, Cassandra and JDBC formats need their connector jars (or
a JDBC driver) on the cluster classpath; in tests the same code paths run on
file sources and parquet.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Producer durability and batching of the source system.
PRODUCER_OPTIONS = {"kafka.acks": "all", "kafka.retries": "3",
                    "kafka.batch.size": "16384", "kafka.linger.ms": "5"}


def read(spark: SparkSession, fmt: str, options: Mapping[str, str] | None = None,
         path: str | None = None, schema: StructType | None = None) -> DataFrame:
    """Batch read of any format (`parquet`, `json`, `jdbc`, a lake connector ...)."""
    reader = spark.read.format(fmt).options(**dict(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def read_stream(spark: SparkSession, fmt: str, options: Mapping[str, str] | None = None,
                path: str | None = None, schema: StructType | None = None) -> DataFrame:
    """Streaming source, e.g. `kafka` with subscribe + startingOffsets=earliest,
    or `text` over a folder of JSON lines. Offsets then come from the checkpoint."""
    reader = spark.readStream.format(fmt).options(**dict(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def kafka_source_options(bootstrap: str, topic: str, starting: str = "earliest",
                         max_offsets_per_trigger: int | None = None,
                         min_partitions: int | None = None) -> dict[str, str]:
    """Options for a Kafka stream source.

    A topic has few partitions (6 in the source system); `min_partitions`
    splits offset ranges so a micro-batch is read by more tasks than that, and
    `max_offsets_per_trigger` bounds each micro-batch.
    """
    opts = {"kafka.bootstrap.servers": bootstrap, "subscribe": topic,
            "startingOffsets": starting}
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions:
        opts["minPartitions"] = str(min_partitions)
    return opts


def jdbc_query(spark: SparkSession, url: str, query: str,
               properties: Mapping[str, str] | None = None) -> DataFrame:
    """Run `query` inside the database (a `dbtable` subquery); the result is
    whatever the database returns -- e.g. one MAX row -- in one partition."""
    return (spark.read.format("jdbc")
            .option("url", url)
            .option("dbtable", f"({query}) jt_q")
            .options(**dict(properties or {}))
            .load())


def jdbc_table(spark: SparkSession, url: str, table: str, partition_column: str,
               lower_bound: int, upper_bound: int, num_partitions: int,
               properties: Mapping[str, str] | None = None, fetch_size: int = 10000) -> DataFrame:
    """Parallel read of a large table: `num_partitions` range queries on a
    numeric/date column instead of the single-connection default."""
    return (spark.read.format("jdbc")
            .option("url", url).option("dbtable", table)
            .option("partitionColumn", partition_column)
            .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
            .option("numPartitions", str(num_partitions))
            .option("fetchsize", str(fetch_size))
            .options(**dict(properties or {}))
            .load())


def jdbc_append(df: DataFrame, url: str, table: str,
                properties: Mapping[str, str] | None = None,
                columns: Iterable[str] | None = None,
                num_partitions: int | None = None, batch_size: int = 10000) -> None:
    """Append rows to an existing table, matched by column name.

    `columns` keeps a chosen column list in order. `num_partitions` caps the
    number of concurrent connections (coalesce, no shuffle).
    """
    if columns is not None:
        df = df.select(*columns)
    if num_partitions:
        df = df.coalesce(num_partitions)
    (df.write.format("jdbc")
       .option("url", url).option("dbtable", table)
       .option("batchsize", str(batch_size))
       .options(**dict(properties or {}))
       .mode("append").save())


def write(df: DataFrame, fmt: str, options: Mapping[str, str] | None = None,
          path: str | None = None, mode: str = "append",
          partition_by: Iterable[str] | None = None) -> None:
    """Batch write of any format (parquet, a lake connector, kafka ...)."""
    writer = df.write.format(fmt).options(**dict(options or {})).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path) if path else writer.save()


def kafka_publish(envelope: DataFrame, bootstrap: str, topic: str,
                  extra_options: Mapping[str, str] | None = None) -> bool:
    """Publish a key/value envelope; an empty input is a no-op (returns False).

    Producer settings default to PRODUCER_OPTIONS; `extra_options` override.
    """
    if envelope.isEmpty():
        return False
    opts = {"kafka.bootstrap.servers": bootstrap, "topic": topic, **PRODUCER_OPTIONS}
    opts.update(dict(extra_options or {}))
    (envelope.select(F.col("key").cast("string"), F.col("value").cast("string"))
     .write.format("kafka").options(**opts).save())
    return True
