"""One key holding a third of all rows: results stay whole, plans combine early."""

from pyspark.sql import functions as F

from jobtide import operators as O

N = 30000


def skewed(spark):
    """A third of the rows share one title+url (one dedup key)."""
    df = spark.range(N).select(
        F.col("id").cast("string").alias("job_id"),
        F.when(F.col("id") % 3 == 0, F.lit("Hot Title")).otherwise(
            F.concat(F.lit("t"), (F.col("id") % 1000).cast("string"))).alias("title"),
        F.when(F.col("id") % 3 == 0, F.lit("u")).otherwise(
            F.concat(F.lit("u"), (F.col("id") % 997).cast("string"))).alias("url"),
        F.lit("src").alias("source"),
        (F.lit(1_700_000_000) + F.col("id")).cast("timestamp").alias("scraped_at"))
    return O.with_dedup_key(df, ts=None)


def test_dedup_hot_key_keeps_earliest(spark):
    out = O.dedup_batch(skewed(spark), keys=["dedup_key"])
    hot = out.filter(F.col("dedup_key") == "job:hot title::u").collect()
    assert len(hot) == 1 and hot[0].job_id == "0" and hot[0].n_copies == N // 3
    total = out.agg(F.sum("n_copies")).first()[0]
    assert total == N  # every row accounted for


def test_anti_join_hot_key_whole_result(spark):
    rows = skewed(spark)
    seen = rows.filter(F.col("job_id").cast("int") < 3).select("dedup_key")  # contains the hot key
    kept = O.drop_seen(rows, seen, keys=["dedup_key"])
    brute = {r.dedup_key for r in seen.collect()}
    want = sum(1 for r in rows.select("dedup_key").collect() if r.dedup_key not in brute)
    assert kept.count() == want
    assert kept.filter(F.col("dedup_key") == "job:hot title::u").count() == 0


def test_current_view_hot_key(spark):
    df = spark.range(N).select(F.lit("s").alias("source"),
                               F.lit("2025-01-01").cast("timestamp").alias("scraped_at"),
                               F.when(F.col("id") % 3 == 0, F.lit("hot"))
                               .otherwise(F.col("id").cast("string")).alias("job_id"),
                               (F.col("id") % 11).alias("batch_id"),
                               F.col("id").cast("string").alias("title"))
    cur = O.lake_current(df)
    assert cur.count() == 1 + (N - N // 3)
    hot = cur.filter("job_id = 'hot'").first()
    assert hot.batch_id == 10


def test_cap_hot_group(spark):
    pages = spark.range(N).select(F.col("id").alias("page_id"),
                                  F.when(F.col("id") % 3 == 0, F.lit("http://hot.example/x?page=1"))
                                  .otherwise(F.concat(F.lit("http://h"), (F.col("id") % 50).cast("string"),
                                                      F.lit(".example/"))).alias("url"))
    capped = O.cap_listing(pages, 5, 2)
    hot = capped.filter("host = 'hot.example'").orderBy("page_id").collect()
    assert [r.page_id for r in hot] == [0, 3]
    assert capped.count() == 2 * 51
