"""Streaming ingest over a JSON-lines folder; replay; dedup by sets that expire whole."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from jobtide import operators as O
from jobtide import streaming as ST
from jobtide.streaming import dedup, progress
from test_ingest import STREAM_LINES


def write_lines(path, lines, name):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as fh:
        fh.write("\n".join(lines) + "\n")


def test_stream_ingest_and_replay(spark, tmp_dir):
    src, lake, ckpt = f"{tmp_dir}/in", f"{tmp_dir}/lake", f"{tmp_dir}/ckpt"
    write_lines(src, STREAM_LINES[:3], "a.json")
    write_lines(src, STREAM_LINES[3:], "b.json")
    counts = ST.stream_ingest(spark, "text", {"maxFilesPerTrigger": "1"}, lake, ckpt, path=src)
    assert sum(c["received"] for c in counts) == len(STREAM_LINES)
    assert sum(c["rejected"] for c in counts) == len(STREAM_LINES) - 3
    assert sum(c["written"] for c in counts) == 3
    rows = O.read_lake(spark, lake)
    assert sorted(r.job_id for r in rows.collect()) == ["1", "1", "2"]
    assert sorted(r.batch_id for r in rows.select("batch_id").distinct().collect()) == [0, 1]
    # Same checkpoint again: nothing new, nothing doubled.
    ST.stream_ingest(spark, "text", {"maxFilesPerTrigger": "1"}, lake, ckpt, path=src)
    assert O.read_lake(spark, lake).count() == 3
    # A new file continues from the checkpoint.
    write_lines(src, [STREAM_LINES[0].replace('"1"', '"7"')], "c.json")
    ST.stream_ingest(spark, "text", {"maxFilesPerTrigger": "1"}, lake, ckpt, path=src)
    assert O.read_lake(spark, lake).count() == 4


def test_replayed_batch_overwrites_its_folder(spark, tmp_dir):
    from test_ingest import messages
    lake = f"{tmp_dir}/lake"
    batch = O.parse_records(messages(spark))
    O.write_lake_batch(batch, 0, lake)
    O.write_lake_batch(batch, 0, lake)
    assert O.read_lake(spark, lake).count() == 3


def test_a_fresh_checkpoint_keeps_the_history_of_the_lake(spark, tmp_dir):
    src, lake = f"{tmp_dir}/in", f"{tmp_dir}/lake"
    write_lines(src, STREAM_LINES, "a.json")
    ST.stream_ingest(spark, "text", {}, lake, f"{tmp_dir}/ckpt1", path=src)
    other = f"{tmp_dir}/in2"
    write_lines(other, [STREAM_LINES[0].replace('"1"', '"9"')], "b.json")
    ST.stream_ingest(spark, "text", {}, lake, f"{tmp_dir}/ckpt2", path=other)
    rows = O.read_lake(spark, lake)
    assert sorted(r.job_id for r in rows.collect()) == ["1", "1", "2", "9"]
    assert {(r.run, r.batch_id) for r in rows.collect()} == {(0, 0), (1, 0)}
    # The same message through the second stream is the later version.
    write_lines(other, STREAM_LINES, "c.json")
    ST.stream_ingest(spark, "text", {}, lake, f"{tmp_dir}/ckpt2", path=other)
    current = O.lake_current(O.read_lake(spark, lake).drop("scraped_month"))
    assert {r.run for r in current.filter("job_id = '1'").collect()} == {1}


ARRIVALS = "arrived_at timestamp, title string, job_id string, url string"


def accepted(spark, tmp_dir, files, per_trigger):
    """Job ids accepted from rows (second of arrival, title, job id), a file per list."""
    import tempfile
    base = tempfile.mkdtemp(dir=tmp_dir)
    for k, rows in enumerate(files):
        lines = ['{"arrived_at":"2025-07-01T09:%02d:%02dZ","title":"%s","job_id":"%s","url":"u"}'
                 % (s // 60, s % 60, t, j) for s, t, j in rows]
        write_lines(f"{base}/in", lines, f"{k}.json")
        os.utime(f"{base}/in/{k}.json", (1_700_000_000 + 10 * k,) * 2)  # file order = arrival order
    rows = (spark.readStream.schema(ARRIVALS).option("maxFilesPerTrigger", str(per_trigger)).json(f"{base}/in"))
    out = ST.stream_dedup(rows, f"{base}/accepted", f"{base}/checkpoint")
    return sorted(r.job_id for r in out.collect())


def test_a_set_opens_with_an_arrival_and_expires_whole(spark, tmp_dir):
    """The set of the first arrival (second 50) ends at 110, not on the minute; B, added late in
    it, comes back as early as 111; the next set runs from 111 to 171."""
    files = [[(50, "A", "1"), (61, "A", "2")], [(109, "A", "3"), (105, "B", "4")],
             [(111, "B", "5"), (112, "A", "6"), (170, "B", "7")], [(171, "B", "8"), (600, "A", "9")]]
    for per_trigger in (1, 2, 4):
        assert accepted(spark, tmp_dir, files, per_trigger) == ["1", "4", "5", "6", "8", "9"]


def test_a_new_day_has_a_set_of_its_own(spark, tmp_dir):
    rows = spark.createDataFrame([(s, t, j, "u") for s, t, j in
                                  [("2025-07-01 23:59:50", "A", "1"), ("2025-07-02 00:00:01", "A", "2"),
                                   ("2025-07-02 00:00:40", "A", "3"), ("2025-07-02 00:01:01", "A", "4"), (None, "A", "5")]],
                                 "at string, title string, job_id string, url string") \
        .withColumn("arrived_at", F.to_timestamp("at")).drop("at")
    ST.accept_batch(rows, f"{tmp_dir}/sets", 0, 0)
    assert sorted(r.job_id for r in ST.accepted_keys(spark, f"{tmp_dir}/sets").collect()) == ["1", "2", "4"]


def test_an_unseen_key_is_never_lost(spark, tmp_dir):
    """A key that was not seen and arrives 35 minutes out of order is accepted."""
    files = [[(2400, "A", "1")], [(2460, "B", "2")], [(2520, "C", "3")], [(300, "D", "4"), (2450, "A", "5")]]
    for per_trigger in (1, 4):
        assert accepted(spark, tmp_dir, files, per_trigger) == ["1", "2", "3", "4"]


def arrivals(spark, rows):
    """(milliseconds, key, job id) as a batch."""
    return spark.createDataFrame(rows, "ms long, dedup_key string, job_id string") \
        .withColumn("arrived_at", F.timestamp_millis("ms")).drop("ms")


def brute_sets(rows, seconds=60):
    """(set start, key, job id) accepted from (milliseconds, key, job id) in order of time."""
    starts, held, out = None, set(), []
    for at, key, job in sorted(rows):
        if starts is None or at >= starts + seconds * 1000 or at // 86_400_000 != starts // 86_400_000:
            starts, held = at, set()
        if key not in held:
            held.add(key)
            out.append((starts, key, job))
    return sorted(out)


def kept(spark, path):
    return sorted((int(r.set_start.timestamp() * 1000 + 0.5), r.dedup_key, r.job_id)
                  for r in ST.accepted_keys(spark, path).collect())


@pytest.mark.parametrize("seed", range(3))
def test_sets_match_brute_force_however_the_stream_is_cut(spark, tmp_dir, seed):
    rng, at, rows = random.Random(seed), 86_400_000 * 20_000 - 200_000, []
    for k in range(150):
        at += rng.choice([0, 1, 400, 9_000, 30_000, 59_999, 60_000, 60_001, 3_700_000])
        rows.append((at, f"k{rng.randrange(6)}", f"{k:03}"))
    for cut in (1, 4):
        path = f"{tmp_dir}/cut{cut}"
        for b in range(cut):
            part = rows[b * len(rows) // cut:(b + 1) * len(rows) // cut]
            ST.accept_batch(arrivals(spark, part), path, 0, b)
        assert kept(spark, path) == brute_sets(rows)


def test_a_replayed_batch_and_a_new_checkpoint_keep_what_was_accepted(spark, tmp_dir):
    path = f"{tmp_dir}/sets"
    ST.accept_batch(arrivals(spark, [(1_000, "a", "1"), (2_000, "b", "2")]), path, 0, 0)
    again = arrivals(spark, [(6_000, "a", "3"), (7_000, "c", "4")])
    for _ in range(2):  # the second time replays the batch
        ST.accept_batch(again, path, 0, 1)
        assert kept(spark, path) == [(1000, "a", "1"), (1000, "b", "2"), (1000, "c", "4")]
    ST.accept_batch(arrivals(spark, [(8_000, "a", "5"), (62_000, "b", "6")]), path, 1, 0)  # batches count from 0 again
    assert kept(spark, path) == [(1000, "a", "1"), (1000, "b", "2"), (1000, "c", "4"), (62000, "b", "6")]


def test_a_stream_with_a_lost_checkpoint_continues_the_open_set(spark, tmp_dir):
    def run(name, lines):
        write_lines(f"{tmp_dir}/{name}", lines, "0.json")
        rows = spark.readStream.schema(ARRIVALS).json(f"{tmp_dir}/{name}")
        return ST.stream_dedup(rows, f"{tmp_dir}/accepted", f"{tmp_dir}/checkpoint-{name}")

    def line(second, title, job):
        return '{"arrived_at":"2025-07-01T09:00:%02dZ","title":"%s","job_id":"%s","url":"u"}' % (second, title, job)

    run("first", [line(1, "a", "1"), line(2, "b", "2")])
    out = run("second", [line(6, "a", "3"), line(7, "c", "4")])
    assert sorted(r.job_id for r in out.collect()) == ["1", "2", "4"]


def test_a_batch_reads_the_hours_of_its_sets_only(spark, tmp_dir):
    path, read = f"{tmp_dir}/sets", []
    for b in range(50):
        ST.accept_batch(arrivals(spark, [(b * 1_800_000 + k, f"k{k}", f"{b}-{k}") for k in range(20)]), path, 0, b)
    for b in (3, 25, 49):
        hour = b // 2
        before = dedup.before_batch(spark, path, 0, b, hour, hour)
        plan = before._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(set_hour" in plan and "ReadSchema" in plan
        read.append(len({r.f for r in before.select(F.input_file_name().alias("f")).collect()}))
    assert max(read) <= 2 * read[0] <= 8  # flat, though 50 batches lie there
    assert len(kept(spark, path)) == 1000


def test_a_batch_writes_few_files_an_hour(spark, tmp_dir):
    """Tasks and hours both grow with a batch; its files grow with the hours only."""
    rows = spark.range(0, 40_000).select(F.timestamp_millis(F.col("id") * 9_000).alias("arrived_at"),
                                         F.concat(F.lit("k"), "id").alias("dedup_key"), F.col("id").cast("string").alias("job_id"))
    kept_apart = {"spark.sql.adaptive.coalescePartitions.enabled": "false"}  # as in a batch with much for each task
    before = {k: spark.conf.get(k) for k in kept_apart}
    try:
        for k, v in kept_apart.items():
            spark.conf.set(k, v)
        ST.accept_batch(rows, f"{tmp_dir}/sets", 0, 0)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    files = ST.accepted_keys(spark, f"{tmp_dir}/sets").select("set_hour", F.input_file_name().alias("f")) \
        .groupBy("set_hour").agg(F.count_distinct("f").alias("n"), F.count(F.lit(1)).alias("rows")).collect()
    assert len(files) == 100 and max(f.n for f in files) == 1 and sum(f.rows for f in files) == 40_000


def test_whole_hours_of_old_sets_expire(spark, tmp_dir):
    path = f"{tmp_dir}/sets"
    assert ST.expire_sets(spark, path, dt.datetime(2030, 1, 1)) == []
    ST.accept_batch(arrivals(spark, [(k * 3_600_000, "a", str(k)) for k in range(5)]), path, 0, 0)
    assert ST.expire_sets(spark, path, dt.datetime(1970, 1, 1, 2, 30, tzinfo=dt.timezone.utc)) == [0, 1]
    assert [r[2] for r in kept(spark, path)] == ["2", "3", "4"]
    ST.accept_batch(arrivals(spark, [(4 * 3_600_000 + 5, "a", "5")]), path, 0, 1)
    assert [r[2] for r in kept(spark, path)] == ["2", "3", "4"]


def test_dedup_does_not_depend_on_the_batches(spark):
    from jobtide.plans.queries import dedup_stream
    results = [sorted(tuple(r) for r in dedup_stream(spark, "/root/testdata/sf0.001", n).collect())
               for n in (1, 3)]
    assert results[0] == results[1]


def test_processing_time_trigger_bounded_run(spark, tmp_dir):
    """Trigger every second, stop after a fixed time whether caught up or not."""
    import time
    src, lake, ckpt = f"{tmp_dir}/in", f"{tmp_dir}/lake", f"{tmp_dir}/ckpt"
    write_lines(src, STREAM_LINES, "a.json")
    t0 = time.time()
    ST.stream_ingest(spark, "text", {}, lake, ckpt, path=src, processing_time="1 second",
                     available_now=False, timeout_s=15)
    assert time.time() - t0 < 60
    assert O.read_lake(spark, lake).count() == 3
    assert not [q for q in spark.streams.active]  # stopped on the way out


def test_progress_table_has_a_row_per_batch(spark, tmp_dir):
    src, lake, ckpt, path = (f"{tmp_dir}/{n}" for n in ("in", "lake", "ckpt", "progress"))
    assert ST.read_progress(spark, path).count() == 0
    write_lines(src, STREAM_LINES[:3], "a.json")
    write_lines(src, STREAM_LINES[3:], "b.json")
    quarantined = STREAM_LINES[0].replace('"source":"', '"source":"","x":"')
    write_lines(src, [quarantined, STREAM_LINES[0]], "c.json")
    counts = ST.stream_ingest(spark, "text", {"maxFilesPerTrigger": "1"}, lake, ckpt, path=src, progress_path=path)
    rows = ST.last_reports(ST.read_progress(spark, path)).orderBy("batch_id").collect()
    assert [r.batch_id for r in rows] == [0, 1, 2]
    for r, c in zip(rows, counts):
        assert {k: r[k] for k in ("received", "rejected", "quarantined", "written")} == \
            {k: c[k] for k in ("received", "rejected", "quarantined", "written")}
        assert r.input_rows == r.received and r.took_ms >= 0 and r.state_rows == 0
    assert sum(r.quarantined for r in rows) == sum(c["quarantined"] for c in counts)
    # The stream resumes: the next batch is reported under its new run.
    write_lines(src, [STREAM_LINES[0]], "d.json")
    ST.stream_ingest(spark, "text", {"maxFilesPerTrigger": "1"}, lake, ckpt, path=src, progress_path=path)
    rows = ST.last_reports(ST.read_progress(spark, path)).collect()
    assert sorted(r.batch_id for r in rows) == [0, 1, 2, 3] and len({r.run for r in rows}) == 2
    assert len({r.stream for r in rows}) == 1


@pytest.mark.parametrize("with_progress", [True, False])
def test_a_batch_without_a_good_message_is_counted(spark, tmp_dir, with_progress):
    """Batches of only rejects, only quarantined rows and nothing between good ones: counts are whole."""
    src, lake, ckpt, path = (f"{tmp_dir}/{n}" for n in ("in", "lake", "ckpt", "progress"))
    quarantined = STREAM_LINES[0].replace('"source":"', '"source":"","x":"')
    batches = [[STREAM_LINES[0]], ['{"title": "no id"}', "{"], [quarantined, "{"], ["{"] * 3, [STREAM_LINES[0]]]
    for k, lines in enumerate(batches):
        write_lines(src, lines, f"{k}.json")
        os.utime(f"{src}/{k}.json", (1_700_000_000 + 10 * k,) * 2)
    counts = ST.stream_ingest(spark, "text", {"maxFilesPerTrigger": "1"}, lake, ckpt, path=src,
                              progress_path=path if with_progress else None)
    names = ("received", "rejected", "quarantined", "written")
    want = [(1, 0, 0, 1), (2, 2, 0, 0), (2, 1, 1, 0), (3, 3, 0, 0), (1, 0, 0, 1)]
    assert [tuple(c[n] for n in names) for c in counts] == want
    assert O.read_lake(spark, lake).count() == 2
    assert spark.read.parquet(f"{lake}/_quarantine/run=0/batch_id=2").count() == 1
    if with_progress:
        rows = ST.last_reports(ST.read_progress(spark, path)).orderBy("batch_id").collect()
        assert [tuple(r[n] for n in names) for r in rows] == want
        assert [r.input_rows for r in rows] == [w[0] for w in want]


def test_reports_of_any_source_become_rows():
    report = {"batchId": 4, "timestamp": "2026-12-02T10:00:00.000Z", "numInputRows": 7, "id": "s", "runId": "r",
              "batchDuration": 12, "sources": [{"metrics": {"maxOffsetsBehindLatest": "5"}}, {"metrics": None}, {}],
              "stateOperators": [{"numRowsTotal": 3, "memoryUsedBytes": 10}, {"numRowsTotal": 4, "memoryUsedBytes": 1}]}
    assert progress.progress_row(report) == (4, "2026-12-02T10:00:00.000Z", 7, 0.0, 12, 5, 7, 11, None, None, None, None, "s", "r")
