"""Lake layout, per-batch folders, last-write-wins current view."""

from pyspark.sql import functions as F

from jobtide import operators as O
from jobtide import sources as S

SF = "/root/testdata/sf0.001"


def test_upsert_latest_batch_wins(spark, tmp_dir):
    lake = S.jobs_as_lake(S.jobs(spark, SF))
    changed = lake.filter(F.col("job_id").cast("int") % 2 == 0) \
        .withColumn("title", F.lit("changed"))
    O.write_lake_batch(lake, 0, tmp_dir)
    O.write_lake_batch(changed, 1, tmp_dir)
    cur = O.lake_current(O.read_lake(spark, tmp_dir).drop("scraped_month"))
    assert cur.count() == lake.count()
    by_batch = {r.batch_id: r["count"] for r in cur.groupBy("batch_id").count().collect()}
    assert by_batch[1] == changed.count()
    assert cur.filter("batch_id = 1 AND title <> 'changed'").count() == 0


def test_layout_is_partitioned_and_sorted(spark, tmp_dir):
    lake = S.jobs_as_lake(S.jobs(spark, SF))
    O.write_lake_batch(lake, 3, tmp_dir)
    back = O.read_lake(spark, tmp_dir)
    assert {"batch_id", "source", "scraped_month"} <= set(back.columns)
    # Partition pruning on the month folder shows in the scan.
    plan = back.filter("scraped_month >= '1999-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "scraped_month" in plan
    # Inside each file rows are newest first.
    files = back.withColumn("f", F.input_file_name()).groupBy("f") \
        .agg(F.collect_list("scraped_at").alias("ts")).collect()
    for r in files:
        assert r.ts == sorted(r.ts, reverse=True)


def test_lake_current_handles_hot_key(spark):
    """A key repeated many times collapses through a partial aggregate."""
    df = spark.range(0, 20000).select(
        F.lit("src").alias("source"), F.lit("2025-01-01").cast("timestamp").alias("scraped_at"),
        F.lit("hot").alias("job_id"), (F.col("id") % 7).alias("batch_id"),
        F.col("id").cast("string").alias("title"))
    out = O.lake_current(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortAggregate") == 2 and "partial_max" in plan
    r = out.collect()
    assert len(r) == 1 and r[0].batch_id == 6


def test_snapshot_then_newer_batches(spark, tmp_dir):
    lake = S.jobs_as_lake(S.jobs(spark, SF))
    path, snaps = f"{tmp_dir}/lake", f"{tmp_dir}/snap"
    O.write_lake_batch(lake, 0, path)
    O.write_lake_batch(lake.filter(F.col("job_id").cast("int") % 3 == 0)
                       .withColumn("title", F.lit("b1")), 1, path)
    snap = O.snapshot_current(spark, path, snaps, upto=(0, 1))
    O.write_lake_batch(lake.filter(F.col("job_id").cast("int") % 5 == 0)
                       .withColumn("title", F.lit("b2")), 2, path)
    via_snapshot = O.read_current(spark, path, snap, upto=(0, 1))
    later = O.snapshot_current(spark, path, snaps, upto=O.latest_batch(spark, path), snapshot=snap, since=(0, 1))
    assert spark.read.parquet(later).count() == lake.count()
    full = O.read_current(spark, path)
    cols = ["source", "scraped_at", "job_id", "batch_id", "title"]
    a = sorted(tuple(r) for r in via_snapshot.select(*cols).collect())
    b = sorted(tuple(r) for r in full.select(*cols).collect())
    assert a == b and len(a) == lake.count()
    plan = via_snapshot._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "batch_id" in plan


def test_empty_lake_reads_empty(spark, tmp_dir):
    empty = O.read_lake(spark, f"{tmp_dir}/nothing-here")
    assert empty.count() == 0 and {"batch_id", "job_id", "scraped_at"} <= set(empty.columns)
    assert O.lake_current(empty.drop("scraped_month")).count() == 0


def test_null_key_rows_go_to_quarantine(spark, tmp_dir):
    lake = S.jobs_as_lake(S.jobs(spark, SF))
    broken = lake.limit(2).withColumn("source", F.lit(None).cast("string"))
    unnamed = lake.limit(1).withColumn("source", F.lit(""))
    counts = O.write_lake_batch(lake.unionByName(broken).unionByName(unnamed), 0, tmp_dir)
    assert O.read_lake(spark, tmp_dir).count() == lake.count()          # scans skip _quarantine
    q = spark.read.parquet(f"{tmp_dir}/_quarantine/run=0/batch_id=0")
    assert q.count() == 3 and q.filter("source IS NULL").count() == 2
    assert q.filter("source = ''").count() == 1
    assert counts == {"received": lake.count() + 3, "quarantined": 3, "written": lake.count()}


def test_source_that_looks_like_a_number_stays_text(spark, tmp_dir):
    lake = S.jobs_as_lake(S.jobs(spark, SF)).limit(3).withColumn("source", F.lit("007"))
    O.write_lake_batch(lake, 0, tmp_dir)
    back = O.read_lake(spark, tmp_dir)
    assert dict(back.dtypes)["source"] == "string"
    assert {r.source for r in back.collect()} == {"007"}


def test_later_batches_are_read_by_folder(spark, tmp_dir):
    lake = S.jobs_as_lake(S.jobs(spark, SF))
    for run, batch in ((0, 0), (0, 1), (1, 0)):
        O.write_lake_batch(lake, batch, tmp_dir, run=run)
    assert O.latest_batch(spark, tmp_dir) == (1, 0)
    newer = O.read_lake(spark, tmp_dir).filter(O.after(0, 0)).filter("scraped_month >= '1999-01'")
    plan = newer._jdf.queryExecution().executedPlan().toString()
    pruned = plan[plan.index("PartitionFilters"):].split("]")[0]
    assert "run#" in pruned and "batch_id#" in pruned and "scraped_month#" in pruned
    assert {(r.run, r.batch_id) for r in newer.select("run", "batch_id").distinct().collect()} == {(0, 1), (1, 0)}
