"""Write-side merge into the bucketed base."""

import random

import pytest
from pyspark.sql import functions as F

from jobtide import operators as O

COLUMNS = "source string, scraped_at timestamp, job_id string, title string, run int, batch_id long"
KEY = ("source", "scraped_at", "job_id")


def rows(spark, items):
    """(source, second, job id, title, run, batch) as rows of a batch."""
    return spark.createDataFrame(items, "source string, second long, job_id string, title string, run int, batch_id long") \
        .withColumn("scraped_at", F.timestamp_seconds("second")) \
        .select(*(c.split()[0] for c in COLUMNS.split(", ")))


def held(spark, path, like):
    return sorted((r.source, int(r.scraped_at.timestamp()), r.job_id, r.title, r.run, r.batch_id)
                  for r in O.read_merged(spark, path, schema=like.schema).collect())


def brute(batches):
    kept = {}
    for item in (x for batch in batches for x in batch):
        k = item[:3]
        if k not in kept or (item[4:], item[3]) >= (kept[k][4:], kept[k][3]):
            kept[k] = item
    return sorted(kept.values())


def test_merges_match_brute_force(spark, tmp_dir):
    rng, batches = random.Random(2), []
    for b in range(4):
        batches.append([(rng.choice("ab"), rng.randrange(4), f"j{rng.randrange(30)}", f"t{rng.randrange(9)}", 0, b)
                        for _ in range(rng.choice([0, 40, 80]) if b else 60)])
    batches[2] += [("a", 1, "hot", f"t{k % 7}", 0, 2) for k in range(500)]
    for b, batch in enumerate(batches):
        like = rows(spark, batch)
        assert O.merge_batch(spark, tmp_dir, like, (0, b), buckets=4) == b
        assert held(spark, tmp_dir, like) == brute(batches[:b + 1])
    late = [("a", 1, "hot", "stale", 0, 0), ("c", 1, "new", "t", 1, 0)]
    O.merge_batch(spark, tmp_dir, rows(spark, late), (1, 0))
    assert held(spark, tmp_dir, like) == brute([*batches, late])  # a late, older version does not win
    assert O.merged_state(spark, tmp_dir) == {"version": 4, "run": 1, "batch_id": 0, "buckets": 4}


def test_merging_a_batch_twice_changes_nothing(spark, tmp_dir):
    batch = [("a", 1, "x", "one", 0, 0), ("a", 2, "y", "two", 0, 0)]
    like = rows(spark, batch)
    for _ in range(2):
        O.merge_batch(spark, tmp_dir, like, (0, 0))
        assert held(spark, tmp_dir, like) == batch


def test_a_merge_that_dies_before_its_row_is_repeated(spark, tmp_dir, monkeypatch):
    first, second = [("a", 1, "x", "one", 0, 0)], [("a", 1, "x", "two", 0, 1), ("b", 1, "z", "new", 0, 1)]
    like, batch = rows(spark, first), rows(spark, second)
    O.merge_batch(spark, tmp_dir, like, (0, 0))

    def dies(*_, **__):
        raise RuntimeError("died before the row")

    with monkeypatch.context() as patch:
        patch.setattr(type(spark), "createDataFrame", dies)
        with pytest.raises(RuntimeError):
            O.merge_batch(spark, tmp_dir, batch, (0, 1))
    assert held(spark, tmp_dir, like) == first
    O.merge_batch(spark, tmp_dir, batch, (0, 1))
    assert held(spark, tmp_dir, like) == sorted(second)


def test_only_the_batch_is_shuffled(spark, tmp_dir):
    like = rows(spark, [("a", k, f"j{k}", "t", 0, 0) for k in range(100)])
    O.merge_batch(spark, tmp_dir, like, (0, 0), buckets=4)
    base = O.read_merged(spark, tmp_dir, schema=like.schema)
    new = rows(spark, [("a", 5, "j5", "u", 0, 1)])
    plan = O.upserted(base, new, 4)._jdf.queryExecution().executedPlan().toString()
    above_base = plan[:plan.index("FileScan")]
    assert "Bucketed: true" in plan and "SelectedBucketsCount: 4 out of 4" in plan
    assert "Exchange" not in above_base and "SortMergeJoin" in above_base
    read = base._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in read and "Exchange" not in read


def test_merge_lake_reads_new_batches_only(spark, tmp_dir):
    from jobtide import sources as S
    lake = S.jobs_as_lake(S.jobs(spark, "/root/testdata/sf0.001"))
    O.write_lake_batch(lake, 0, f"{tmp_dir}/lake")
    assert O.merge_lake(spark, f"{tmp_dir}/lake", f"{tmp_dir}/base", (0, 0)) == 0
    assert O.merge_lake(spark, f"{tmp_dir}/lake", f"{tmp_dir}/base", (0, 0)) is None
    O.write_lake_batch(lake.limit(50).withColumn("title", F.lit("new")), 1, f"{tmp_dir}/lake")
    assert O.merge_lake(spark, f"{tmp_dir}/lake", f"{tmp_dir}/base", (0, 1)) == 1
    merged = O.read_merged(spark, f"{tmp_dir}/base")
    expected = O.lake_current(O.read_lake(spark, f"{tmp_dir}/lake").drop("scraped_month")).select(*merged.columns)
    assert merged.count() == expected.count() and merged.exceptAll(expected).isEmpty()
    assert O.read_merged(spark, f"{tmp_dir}/nothing").count() == 0
