"""The whole run end to end, twice on the same day; publishing that dies at any step."""

import pytest
from pyspark.sql import functions as F

from jobtide import operators as O
from jobtide import sources as S
from jobtide.plans import outbox
from jobtide.plans.runner import run_all

SF = "/root/testdata/sf0.001"


def test_run_twice_is_idempotent(spark, tmp_dir):
    records = S.jobs_as_records(S.jobs(spark, SF))
    first = run_all(spark, records, work=tmp_dir, day="2026-12-02")
    keys = O.with_dedup_key(records.withColumnRenamed("jobId", "job_id"), ts=None) \
        .select("dedup_key").distinct().count()
    assert first["published"] == keys == first["ingested"]
    # Mart = one row per published posting that survives the negotiable filter.
    want_mart = O.negotiable_filter(O.dedup_batch(
        O.with_dedup_key(records, ts=None), keys=["dedup_key"], order=("jobId",))).count()
    assert first["mart_rows_written"] == want_mart
    assert first["category_count"].agg(F.sum("count")).first()[0] == want_mart

    again = run_all(spark, records, work=tmp_dir, day="2026-12-02")
    assert again["published"] == 0 and again["ingested"] == 0
    assert again["mart_rows_written"] == 0
    assert spark.read.parquet(f"{tmp_dir}/mart").count() == want_mart

    next_day = run_all(spark, records, work=tmp_dir, day="2026-12-03")
    # New day, new seen set: everything is published again, the lake upsert
    # absorbs the repeats, and the mart does not load a key that it holds.
    assert next_day["published"] == keys and next_day["mart_rows_written"] == 0


def test_a_late_posting_reaches_the_mart(spark, tmp_dir):
    """A posting older than all that was loaded, arriving in a later run, is not passed over."""
    records = S.jobs_as_records(S.jobs(spark, SF)).filter("salary LIKE '%triệu%'")
    oldest = records.orderBy("createdAt").first()
    late = (F.col("title") == oldest.title) & (F.col("url") == oldest.url)
    first = run_all(spark, records.filter(~late), work=tmp_dir, day="2026-12-02")
    again = run_all(spark, records, work=tmp_dir, day="2026-12-02")
    assert first["mart_rows_written"] > 0 and again["published"] == again["mart_rows_written"] == 1
    assert again["rejected"] == again["quarantined"] == 0


class Died(Exception):
    pass


def dies(*_, **__):
    raise Died


def messages(spark, *keys):
    return spark.createDataFrame([("k", f"message {k}", k, "2026-12-02") for k in keys],
                                 "key string, value string, dedup_key string, day string") \
        .withColumn("day", F.to_date("day"))


def state(spark, base):
    """Seen keys and delivered messages."""
    seen = sorted(r.dedup_key for r in outbox.committed(spark, f"{base}/box").collect())
    try:
        got = sorted(r.value for r in spark.read.text(f"{base}/topic").collect())
    except Exception:
        got = []
    return seen, got


@pytest.mark.parametrize("step", ["before the commit", "before the delivery", "before the rename", "after the rename"])
def test_a_publish_that_dies_neither_loses_nor_repeats(spark, tmp_dir, monkeypatch, step):
    box, topic = f"{tmp_dir}/box", f"{tmp_dir}/topic"
    assert outbox.commit(spark, box, messages(spark, "a", "b")) == 2 and outbox.deliver(spark, box, topic) == 1
    with monkeypatch.context() as patch, pytest.raises(Died):
        if step == "before the commit":
            patch.setattr(outbox, "_note", dies)
        outbox.commit(spark, box, messages(spark, "c", "d"))
        if step == "before the delivery":
            raise Died
        if step == "before the rename":
            real = outbox.file_system

            class NoRename:
                def __init__(self, files):
                    self.exists, self.rename = files.exists, dies

            patch.setattr(outbox, "file_system", lambda *a: (NoRename(real(*a)[0]), real(*a)[1]))
        outbox.deliver(spark, box, topic)
        raise Died
    kept = ["a", "b"] if step == "before the commit" else ["a", "b", "c", "d"]
    assert state(spark, tmp_dir)[0] == kept
    outbox.deliver(spark, box, topic)  # the next run: what is due, then what is not seen
    new = [k for k in ("c", "d", "e") if k not in kept]
    assert outbox.commit(spark, box, messages(spark, *new)) == len(new)
    outbox.deliver(spark, box, topic)
    assert state(spark, tmp_dir) == (list("abcde"), [f"message {k}" for k in "abcde"])
    assert outbox.commit(spark, box, messages(spark, "a").limit(0)) == 0 and outbox.deliver(spark, box, topic) == 0


def test_a_broker_gets_what_was_not_noted_as_sent(spark, tmp_dir):
    box, sent = f"{tmp_dir}/box", []

    def broker(frame):
        sent.extend(sorted(r.value for r in frame.collect()))

    outbox.commit(spark, box, messages(spark, "a"))
    assert outbox.send(spark, box, broker) == 1 and outbox.send(spark, box, broker) == 0
    outbox.commit(spark, box, messages(spark, "b"))
    with pytest.raises(Died):
        outbox.send(spark, box, dies)
    assert outbox.send(spark, box, broker) == 1 and sent == ["message a", "message b"]


def test_a_run_that_died_after_its_commit_is_completed_by_the_next(spark, tmp_dir, monkeypatch):
    records = S.jobs_as_records(S.jobs(spark, SF)).filter("salary LIKE '%triệu%'")
    with monkeypatch.context() as patch, pytest.raises(Died):
        real, calls = outbox.deliver, []
        patch.setattr(outbox, "deliver", lambda *a: dies() if calls else calls.append(real(*a)))
        run_all(spark, records, work=tmp_dir, day="2026-12-02")
    done = run_all(spark, records, work=tmp_dir, day="2026-12-02")
    keys = O.with_dedup_key(records, ts=None).select("dedup_key").distinct().count()
    assert done["published"] == 0 and done["ingested"] == keys
    assert spark.read.text(f"{tmp_dir}/topic").count() == keys
