"""High-water mark, strict incremental filter, the whole batch job."""

import datetime as dt

from pyspark.sql import functions as F

from jobtide import operators as O
from jobtide import sources as S

SF = "/root/testdata/sf0.001"


def test_mark_default_when_empty(spark):
    empty = spark.createDataFrame([], "scraped_at string")
    assert O.mark_value(O.high_water_mark(empty)) == dt.datetime(2000, 1, 1)
    nulls = spark.createDataFrame([(None,)], "scraped_at string")
    assert O.mark_value(O.high_water_mark(nulls)) == dt.datetime(2000, 1, 1)


def test_mark_from_text_and_timestamp(spark):
    t = spark.createDataFrame([("2025-07-01 09:30:05",), ("2025-06-30 23:59:59",)], "scraped_at string")
    assert O.mark_value(O.high_water_mark(t)) == dt.datetime(2025, 7, 1, 9, 30, 5)
    ts = t.select(F.to_timestamp("scraped_at").alias("scraped_at"))
    assert O.mark_value(O.high_water_mark(ts)) == dt.datetime(2025, 7, 1, 9, 30, 5)


def test_incremental_is_strict(spark):
    df = spark.createDataFrame([(dt.datetime(2025, 7, 1, 9, 30, 5),), (dt.datetime(2025, 7, 1, 9, 30, 6),)],
                               "scraped_at timestamp")
    out = O.incremental_load(df, dt.datetime(2025, 7, 1, 9, 30, 5)).collect()
    assert [r.scraped_at for r in out] == [dt.datetime(2025, 7, 1, 9, 30, 6)]


def test_filter_reaches_scan_and_prunes(spark, tmp_dir):
    lake = S.jobs_as_lake(S.jobs(spark, SF))
    O.write_lake_batch(lake, 0, tmp_dir)
    back = O.read_lake(spark, tmp_dir)
    out = O.incremental_load(back, dt.datetime(1999, 1, 1), partition_month_col="scraped_month")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(scraped_at), GreaterThan(scraped_at" in plan
    assert "PartitionFilters" in plan
    want = lake.filter(F.col("scraped_at") > F.lit("1999-01-01").cast("timestamp")).count()
    assert out.count() == want


def test_run_incremental_appends_once(spark, tmp_dir):
    lake_path, mart_path = f"{tmp_dir}/lake", f"{tmp_dir}/mart"
    lake = S.jobs_as_lake(S.jobs(spark, SF))
    O.write_lake_batch(lake, 0, lake_path)
    sink = O.parquet_mart_sink(mart_path)
    seed = O.mart_clean(lake.filter(F.col("scraped_at") <= F.lit("1999-01-01").cast("timestamp")))
    seed.write.parquet(mart_path)
    n = O.run_incremental(O.read_lake(spark, lake_path), spark.read.parquet(mart_path), sink)
    assert n == O.mart_clean(lake).count() - seed.count()
    # Second run: nothing newer than the mark, nothing written.
    assert O.run_incremental(O.read_lake(spark, lake_path), spark.read.parquet(mart_path), sink) == 0
    assert spark.read.parquet(mart_path).count() == O.mart_clean(lake).count()


def test_mart_schema(spark):
    from jobtide.schema import MART_SCHEMA
    mart = O.mart_clean(S.jobs_as_lake(S.jobs(spark, SF)))
    assert [(f.name, f.dataType) for f in mart.schema] == [(f.name, f.dataType) for f in MART_SCHEMA]


def test_footers_answer_the_mark(spark, tmp_dir):
    mart = O.mart_clean(S.jobs_as_lake(S.jobs(spark, SF)))
    path, before = f"{tmp_dir}/mart", spark.conf.get("spark.sql.sources.useV1SourceList")
    assert O.mark_value(O.stored_mark(spark, path)) == dt.datetime(2000, 1, 1)
    for part in (mart.limit(0), mart.withColumn("scraped_at", F.lit(None).cast("string"))):
        O.marked_mart_sink(path)(part)
        assert O.mark_value(O.stored_mark(spark, path)) == dt.datetime(2000, 1, 1)
    O.marked_mart_sink(path)(mart.filter("category IS NULL"))
    with O.answered_by_footers(spark):
        plan = O.stored_max(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MAX(_mark)]" in plan
    assert O.stored_mark(spark, path).collect() == O.high_water_mark(mart.filter("category IS NULL")).collect()
    O.marked_mart_sink(path)(mart)
    assert O.stored_mark(spark, path).collect() == O.high_water_mark(mart).collect()
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
