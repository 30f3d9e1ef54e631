"""The seen store: what a probe answers and what it reads."""

import random

import pytest
from pyspark.sql import functions as F

from jobtide import operators as O
from jobtide.operators import seen


def keys(spark, names):
    return spark.createDataFrame([(n, k) for k, n in enumerate(names)], "dedup_key string, job_id long")


@pytest.mark.parametrize("few", [seen.FEW_KEYS, 3])
def test_unseen_matches_brute_force(spark, tmp_dir, monkeypatch, few):
    """By hashes, and beyond FEW_KEYS by a join; hot and null keys, an empty store, an empty run."""
    monkeypatch.setattr(seen, "FEW_KEYS", few)
    rng, held = random.Random(1), set()
    run = keys(spark, ["a", None])
    assert sorted(r.job_id for r in O.unseen(spark, f"{tmp_dir}/seen", run).collect()) == [0, 1]
    for _ in range(3):
        new = [rng.choice(["hot", f"k{rng.randrange(60)}", None]) for _ in range(200)]
        O.store_seen(keys(spark, new), f"{tmp_dir}/seen")
        held |= set(new) - {None}
        names = [rng.choice([f"k{rng.randrange(120)}", "hot", None]) for _ in range(40)]
        got = sorted(r.job_id for r in O.unseen(spark, f"{tmp_dir}/seen", keys(spark, names)).collect())
        assert got == [k for k, n in enumerate(names) if n not in held]
    assert O.unseen(spark, f"{tmp_dir}/seen", keys(spark, ["x"]).limit(0)).count() == 0
    assert O.read_seen(spark, f"{tmp_dir}/seen").filter("dedup_key IS NULL").count() == 0


def rows_read(df):
    """Rows that the file scan of an executed plan gave out."""
    df.collect()
    plan, found = df._jdf.queryExecution().executedPlan(), []

    def walk(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if name.startswith("Scan parquet"):
            found.append(node.metrics().apply("numOutputRows").value())
        children = node.children()
        for k in range(children.size()):
            walk(children.apply(k))

    walk(plan)
    return found


def test_a_probe_reads_the_row_groups_that_may_hold_its_keys(spark, tmp_dir):
    stored = spark.range(200_000).select(F.concat(F.lit("job:"), F.col("id").cast("string")).alias("dedup_key"))
    for part in range(2):  # two appends, each over the whole range of hashes
        O.store_seen(stored.filter(F.xxhash64("dedup_key") % 2 == part), f"{tmp_dir}/seen", row_group_bytes=1 << 16)
    probe = O.probed(spark, f"{tmp_dir}/seen", keys(spark, ["job:77", "job:199999", "new:1", "new:2"]))
    read = rows_read(probe)
    assert sorted(r.dedup_key for r in probe.collect()) == ["job:199999", "job:77"]
    assert len(read) == 1 and read[0] < 0.1 * 200_000
    # Keys that are not there read less than their ranges hold: the bloom filters say no.
    absent = keys(spark, [f"new:{k}" for k in range(20)])
    assert rows_read(O.probed(spark, f"{tmp_dir}/seen", absent))[0] < 0.02 * 200_000
