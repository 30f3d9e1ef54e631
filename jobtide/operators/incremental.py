"""Incremental load: high-water mark -> rows newer than it -> mart append.

The mark is one value (a global MAX over the mart, a MAX that the mart's Parquet
footers answer, or one pushed into the database as a subquery). It is the only value taken to the driver: as a
literal, the `> mark` filter reaches the parquet scan (PushedFilters) and,
on a lake partitioned by `scraped_month`, prunes whole partitions -- a join
against a one-row DataFrame would scan everything.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ingest import with_row_count
from .lake import file_system
from .mart import mart_clean

DEFAULT_MARK = "2000-01-01 00:00:00"
MARK_COLUMN, NO_MARK = "_mark", -(1 << 62)


def high_water_mark(mart: DataFrame, col: str = "scraped_at",
                    default: str = DEFAULT_MARK) -> DataFrame:
    """One row [mark: timestamp]: MAX(col), or `default` when empty or null.

    `col` may be `yyyy-MM-dd HH:mm:ss` text (sorts like time) or a timestamp;
    text is parsed in the session time zone. One partial + final aggregate.
    """
    field = mart.schema[col].dataType
    m = F.max(col)
    if isinstance(field, T.StringType):
        m = F.try_to_timestamp(m, F.lit("yyyy-MM-dd HH:mm:ss"))
    else:
        m = m.cast("timestamp")
    return mart.agg(F.coalesce(m, F.to_timestamp(F.lit(default))).alias("mark"))


def mark_value(mark_df: DataFrame) -> dt.datetime:
    """The single mark value (a one-row aggregate; bounded by construction)."""
    return mark_df.first()["mark"]


def incremental_load(lake: DataFrame, mark: dt.datetime | str, col: str = "scraped_at",
                     partition_month_col: str | None = None) -> DataFrame:
    """Rows with col > mark (strict: rows at the mark's own second are not new).

    When the lake is partitioned by a `yyyy-MM` month column, a matching
    `>= month(mark)` predicate is added so the scan prunes old partitions.
    """
    mark_lit = F.lit(mark).cast(lake.schema[col].dataType)
    out = lake.filter(F.col(col) > mark_lit)
    if partition_month_col and partition_month_col in lake.columns:
        out = out.filter(F.col(partition_month_col) >= F.date_format(mark_lit, "yyyy-MM"))
    return out


def parquet_mart_sink(path: str, partition_by: tuple[str, ...] = ()) -> Callable[[DataFrame], None]:
    """Append mart rows to a parquet table.

    Files become visible only when the whole job commits, so a run that dies
    half-way leaves no rows behind and cannot move the next run's mark past
    rows it never wrote (a non-transactional JDBC append can).
    """
    def sink(df: DataFrame) -> None:
        w = df.write.mode("append")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(path)
    return sink


def marked_mart_sink(path: str, col: str = "scraped_at") -> Callable[[DataFrame], None]:
    """A Parquet mart whose rows carry `col` in seconds since 1970 too, a type whose largest
    value Parquet keeps in its footers, for `stored_mark`."""
    sink = parquet_mart_sink(path)

    def marked(df: DataFrame) -> None:
        text = isinstance(df.schema[col].dataType, T.StringType)
        at = F.try_to_timestamp(F.col(col), F.lit("yyyy-MM-dd HH:mm:ss")) if text else F.col(col).cast("timestamp")
        # Never null: a row group of nulls only has no largest value in its footer.
        sink(df.withColumn(MARK_COLUMN, F.coalesce(F.unix_seconds(at), F.lit(NO_MARK))))
    return marked


@contextmanager
def answered_by_footers(spark: SparkSession) -> Iterator[None]:
    """Parquet through the reader that takes aggregates from footers; the session's own settings come back."""
    v1 = spark.conf.get("spark.sql.sources.useV1SourceList")
    wanted = {"spark.sql.sources.useV1SourceList": ",".join(x for x in v1.split(",") if x.strip() != "parquet"),
              "spark.sql.parquet.aggregatePushdown": "true"}
    before = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def stored_max(spark: SparkSession, path: str) -> DataFrame:
    """The largest mark of a marked mart; inside `answered_by_footers` no row is read.

    The files' own schema is taken, as that reader looks columns up by their place in it.
    """
    return spark.read.parquet(path).agg(F.max(MARK_COLUMN).alias("last"))


def stored_mark(spark: SparkSession, path: str, default: str = DEFAULT_MARK) -> DataFrame:
    """One row [mark: timestamp] as `high_water_mark`, answered by the files' footers: a footer a
    file, whatever the rows. A mart that is not there yet gives the default."""
    files, place = file_system(spark, path)
    last = None
    if files.exists(place(path)):
        with answered_by_footers(spark):
            last = stored_max(spark, path).first()["last"]
    mark = F.to_timestamp(F.lit(default)) if last in (None, NO_MARK) else F.timestamp_seconds(F.lit(last))
    return spark.range(1).select(mark.alias("mark"))


def run_incremental(lake: DataFrame, mart_for_mark: DataFrame,
                    sink: Callable[[DataFrame], None],
                    million_only_if_marked: bool = False,
                    partition_month_col: str | None = "scraped_month",
                    default_mark: str = DEFAULT_MARK) -> int:
    """The whole batch job: mark -> new rows -> empty? stop -> clean -> append.

    Returns the number of mart rows written (observed during the write).
    """
    mark = mark_value(high_water_mark(mart_for_mark, default=default_mark))
    new_rows = incremental_load(lake, mark, partition_month_col=partition_month_col)
    if new_rows.isEmpty():
        return 0
    out, obs = with_row_count(mart_clean(new_rows, million_only_if_marked), "mart_rows")
    sink(out)
    return int(obs.get["rows"])
