"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the given tables (or data Spark derives from them) whole.
Outputs meant for the SQL oracle render arrays as text plus a size, and
dates as ISO text, so both engines hand back plain scalars.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as J
from .. import operators as O
from .. import sources as S
from .. import streaming as ST
from ..session import run_dir
from . import fixtures as FX

# Fixed parameters of the registered queries.
LISTING_MAX_PAGES = 5
LISTING_PER_PAGE = 2
KEYWORDS_PER_DOC = 3
UPDATED_TITLE_SUFFIX = " (updated)"
STREAM_FILES_PER_TRIGGER = 4
STREAM_RUNS = 4


def _jobs(spark, sf_dir):
    return S.jobs(spark, sf_dir)


def _lake(spark, sf_dir):
    return S.jobs_as_lake(_jobs(spark, sf_dir))


def _mark_ts():
    return F.to_timestamp(F.lit(S.FIXTURE_MARK))


def _skills_text(col="skill"):
    c = F.col(col) if isinstance(col, str) else col
    return [F.size(c).cast("bigint").alias("n_skills"), F.array_join(c, "|").alias("skills")]


def _date_text(col):
    return F.col(col).cast("string")


def _envelope(spark, sf_dir) -> DataFrame:
    return O.publish_envelope(S.jobs_as_records(_jobs(spark, sf_dir)))


def _lake_out(df: DataFrame) -> DataFrame:
    return df.select("job_id", "title", "company", "location", "salary", *_skills_text(),
                     "category", "url", "source", "scraped_at", "expired_at", "posted_at")


# ---------------------------------------------------------------- flagship

def category_salary(spark, sf_dir):
    """Postings per clean category and salary unit, with the average salary."""
    return O.category_salary(_jobs(spark, sf_dir))


# ----------------------------------------------------- ingest and publish

def _messages(spark, sf_dir) -> DataFrame:
    return FX.messages(_jobs(spark, sf_dir), _envelope(spark, sf_dir))


def ingest_parse(spark, sf_dir):
    """Wire JSON messages, good and broken, -> parsed lake rows with a complete key."""
    good, _ = O.split_quarantine(O.parse_records(_messages(spark, sf_dir)))
    return _lake_out(good)


def ingest_counts(spark, sf_dir):
    """Messages received, rejected (no id), quarantined (incomplete key) and written."""
    return O.ingest_counts(_messages(spark, sf_dir))


def event_props(spark, sf_dir):
    """Permissive JSON parse of events.props with a fixed schema."""
    ev = S.load_table(spark, sf_dir, "events")
    parsed = F.from_json("props", "k INT", {"mode": "PERMISSIVE"})
    return ev.select("event_id", parsed["k"].alias("k"))


def publish_envelope(spark, sf_dir):
    """Keyed message envelope: key = category, value = the record as JSON."""
    return _envelope(spark, sf_dir)


# ------------------------------------------------------------- cleaning

def skill_split(spark, sf_dir):
    """Skill text -> list (null -> [], '' -> ['']), shown as size + '|'-joined text."""
    j = _jobs(spark, sf_dir)
    return j.select("job_id", "skill", *_skills_text(J.skill_split("skill")))


def skill_join(spark, sf_dir):
    """Lake skill list -> the mart's comma-joined text."""
    return _lake(spark, sf_dir).select("job_id", J.skill_join("skill").alias("skill"))


def scraped_at_parts(spark, sf_dir):
    """Producer int-array time stamps -> timestamp (lenient and strict forms)."""
    rec = S.jobs_as_records(_jobs(spark, sf_dir))
    return rec.select(F.col("jobId").alias("job_id"),
                      F.array_join(F.col("createdAt").cast("array<string>"), ",").alias("created_at"),
                      J.timestamp_from_parts("createdAt").alias("scraped_at"),
                      J.timestamp_from_parts("createdAt", strict=True).alias("scraped_at_strict"))


def date_parse(spark, sf_dir):
    """Wire `dd/MM/yyyy` dates -> timestamps (bad text -> null)."""
    rec = S.jobs_as_records(_jobs(spark, sf_dir))
    kind = F.col("jobId").cast("bigint") % 9
    rec = rec.withColumn("postedAt", F.when(kind == 0, "31/02/2024").when(kind == 1, "soon")
                         .when(kind == 2, "").otherwise(F.col("postedAt")))
    return rec.select(F.col("jobId").alias("job_id"), "postedAt", "expiredAt",
                      J.parse_wire_date("postedAt").alias("posted_at"),
                      J.parse_wire_date("expiredAt").alias("expired_at"))


def date_reformat(spark, sf_dir):
    """Timestamps -> `MM/dd/yyyy` text (direct and via ISO text) and mart dates."""
    lake = _lake(spark, sf_dir)
    return lake.select(
        "job_id",
        J.mdy_text("posted_at").alias("posted_mdy"),
        J.mdy_text_from_iso(J.timestamp_text("expired_at")).alias("expired_mdy"),
        J.mart_date("posted_at").cast("string").alias("posted_date"),
        J.mart_date("expired_at").cast("string").alias("expired_date"))


def relative_expiry(spark, sf_dir):
    """Posted date + 'Hết hạn trong N ngày/tháng/tuần' -> expiry date."""
    j = _jobs(spark, sf_dir)
    d = J.relative_expiry("posted_at", "expire_text")
    return j.select("job_id", "expire_text", J.format_wire_date(d).alias("expired_text"),
                    d.cast("string").alias("expired_date"))


def category_clean(spark, sf_dir):
    """Free-text category -> lower-case first phrase."""
    j = _jobs(spark, sf_dir)
    return j.select("job_id", F.col("category").alias("category_raw"),
                    J.category_clean("category").alias("category"))


def salary_parse(spark, sf_dir):
    """Salary text -> low, high, avg, unit (amounts in millions unless USD)."""
    return O.with_salary(_jobs(spark, sf_dir).select("job_id", "salary"))


def salary_parse_tr(spark, sf_dir):
    """Salary text -> low, high, avg, unit (millions only when marked tr/triệu)."""
    return O.with_salary(_jobs(spark, sf_dir).select("job_id", "salary"),
                         million_only_if_marked=True)


def negotiable_filter(spark, sf_dir):
    """Postings whose salary is not a negotiable phrase (null salary dropped)."""
    return O.negotiable_filter(_jobs(spark, sf_dir)).select("job_id", "salary")


def stable_job_id(spark, sf_dir):
    """Normalized dedup key and its SHA-256 id."""
    k = O.with_dedup_key(_jobs(spark, sf_dir), ts=None)
    return k.select("job_id", "dedup_key", J.stable_id("dedup_key").alias("stable_id"))


def _mart_out(df: DataFrame) -> DataFrame:
    return df.withColumns({"expired_at": _date_text("expired_at"),
                           "posted_at": _date_text("posted_at")})


def mart_clean(spark, sf_dir):
    """Lake rows -> the 13 mart columns (dates shown as ISO text)."""
    return _mart_out(O.mart_clean(_lake(spark, sf_dir)))


# ------------------------------------------------------------ incremental

def _mart_before_mark(spark, sf_dir):
    lake = _lake(spark, sf_dir)
    return O.mart_clean(lake.filter(F.col("scraped_at") <= _mark_ts()))


def high_water_mark(spark, sf_dir):
    """Mark over the mart rows already loaded (those at or before the split)."""
    return O.high_water_mark(_mart_before_mark(spark, sf_dir))


def stored_mark(spark, sf_dir):
    """The same mark from the footers of the stored mart, which two loads have written."""
    path = run_dir(spark, "stored_mark") + "/mart"
    mart, early = _mart_before_mark(spark, sf_dir), F.col("posted_at") < F.lit("1995-01-01").cast("date")
    for part in (mart.filter(early), mart.filter(~F.coalesce(early, F.lit(False)))):
        O.marked_mart_sink(path)(part)
    return O.stored_mark(spark, path)


def incremental_load(spark, sf_dir):
    """Lake rows newer than the mart's high-water mark."""
    mark = O.mark_value(O.high_water_mark(_mart_before_mark(spark, sf_dir)))
    new_rows = O.incremental_load(_lake(spark, sf_dir), mark)
    return new_rows.select("job_id", "source", "title", "scraped_at")


def incremental_mart(spark, sf_dir):
    """The whole batch job's output: mark -> newer lake rows -> mart rows."""
    mark = O.mark_value(O.high_water_mark(_mart_before_mark(spark, sf_dir)))
    return _mart_out(O.mart_clean(O.incremental_load(_lake(spark, sf_dir), mark)))


# ---------------------------------------------------------------- rollups

def location_count(spark, sf_dir):
    """Postings per location (expiry notes excluded)."""
    return O.location_count(_lake(spark, sf_dir))


def category_count(spark, sf_dir):
    """Mart postings per clean category."""
    return O.category_count(O.mart_clean(_lake(spark, sf_dir)), clean=False)


# ------------------------------------------------------------------ dedup

def _keyed(spark, sf_dir):
    return O.with_dedup_key(_lake(spark, sf_dir))


def dedup_batch(spark, sf_dir):
    """One row per (day, key): the earliest copy, with the number of copies."""
    d = O.dedup_batch(_keyed(spark, sf_dir))
    return d.select(_date_text("day").alias("day"), "dedup_key", "job_id", "scraped_at",
                    "n_copies")


def seen_keys_by_day(spark, sf_dir):
    """Distinct (day, key) members of the seen set before the split."""
    k = _keyed(spark, sf_dir).filter(F.col("scraped_at") <= _mark_ts())
    return O.seen_keys(k).select(_date_text("day").alias("day"), "dedup_key")


def dedup_against_seen(spark, sf_dir):
    """New rows whose key was never seen before the split (seen set = all
    keys at or before it)."""
    k = _keyed(spark, sf_dir)
    seen = O.seen_keys(k.filter(F.col("scraped_at") <= _mark_ts()), keys=["dedup_key"])
    new = k.filter(F.col("scraped_at") > _mark_ts())
    return O.drop_seen(new, seen, keys=["dedup_key"]).select("job_id", "dedup_key", "scraped_at")


def seen_probe(spark, sf_dir):
    """The newest day's postings whose key is in no earlier day: a run probes the stored seen set."""
    path, keyed = run_dir(spark, "seen_probe") + "/seen", _keyed(spark, sf_dir)
    today = keyed.agg(F.max("day")).first()[0]
    O.store_seen(keyed.filter(F.col("day") < F.lit(today)), path)
    run = keyed.filter(F.col("day") == F.lit(today))
    return O.unseen(spark, path, run).select("job_id", "dedup_key", "scraped_at")


def merge_sources(spark, sf_dir):
    """Union by name of the two collectors' outputs (different column orders)."""
    rec = S.jobs_as_records(_jobs(spark, sf_dir))
    a = rec.filter(F.col("source") == "VietnamWorks").select("jobId", "source", "title", "url",
                                                             "company")
    b = rec.filter(F.col("source") == "Careerviet").select("company", "url", "title", "source",
                                                           "jobId")
    return O.merge_sources(a, b).withColumnRenamed("jobId", "job_id")


# ------------------------------------------------------------------- lake

def lake_layout(spark, sf_dir):
    """Postings in lake storage order with their month partition."""
    out = O.lake_layout(_lake(spark, sf_dir))
    return out.select("job_id", "source", "scraped_at", "scraped_month")


def lake_current(spark, sf_dir):
    """Two idempotent batch writes (batch 1 retitles every row) -> current view."""
    path = run_dir(spark, "lake_current") + "/lake"
    lake = _lake(spark, sf_dir).select("job_id", "source", "scraped_at", "title")
    O.write_lake_batch(lake, 0, path)
    O.write_lake_batch(lake.withColumn("title", F.concat("title", F.lit(UPDATED_TITLE_SUFFIX))),
                       1, path)
    stored = O.read_lake(spark, path).select("job_id", "source", "scraped_at", "title", "run", "batch_id")
    return O.lake_current(stored).select("job_id", "source", "scraped_at", "title", "batch_id")


def lake_newer(spark, sf_dir):
    """Incremental load by lake batch: a late batch brings every third posting, whatever
    its time stamp; it is read alone, by folder, after a snapshot of what was there."""
    path = run_dir(spark, "lake_newer")
    lake, late = _lake(spark, sf_dir), F.col("job_id").cast("bigint") % 3 == 0
    O.write_lake_batch(lake.filter(~late), 0, f"{path}/lake")
    loaded = O.latest_batch(spark, f"{path}/lake")
    O.write_lake_batch(lake.filter(late), 1, f"{path}/lake")
    newer = O.read_lake(spark, f"{path}/lake").filter(O.after(*loaded))
    return O.lake_current(newer).select("job_id", "source", "title", "scraped_at", "batch_id")


def lake_merged(spark, sf_dir):
    """Write-side upsert: two lake batches are merged into a base bucketed on the key, one after the
    other; the second renews half of the postings. The current view is a scan of the base."""
    path = run_dir(spark, "lake_merged")
    number, lake = F.col("job_id").cast("bigint"), _lake(spark, sf_dir)
    retitled = lake.withColumn("title", F.concat("title", F.lit(UPDATED_TITLE_SUFFIX)))
    for batch_id, rows in enumerate((lake.filter(number % 3 > 0), retitled.filter(number % 2 == 0))):
        O.write_lake_batch(rows, batch_id, f"{path}/lake")
        O.merge_lake(spark, f"{path}/lake", f"{path}/base", (0, batch_id))
    return O.read_merged(spark, f"{path}/base").select(
        "job_id", "source", "scraped_at", "title", *_skills_text(), "posted_at", "batch_id")


# ------------------------------------------------------------------ pages

def cap_per_group(spark, sf_dir):
    """First 2 items of pages 1..5 of each listing host."""
    pages = S.load_table(spark, sf_dir, "pages")
    capped = O.cap_listing(pages, LISTING_MAX_PAGES, LISTING_PER_PAGE)
    return capped.select("host", F.col("page").cast("bigint").alias("page"), "page_id",
                         F.col("pos").cast("bigint").alias("pos"))


def page_fields(spark, sf_dir):
    """Title, third list item and requirement text from whole HTML pages."""
    return O.page_fields(S.load_table(spark, sf_dir, "pages"))


def page_postings(spark, sf_dir):
    """The fields of every posting, taken back from its detail page."""
    return O.page_postings(FX.rendered_pages(_jobs(spark, sf_dir)), label_source=FX.LABEL_SOURCE)


def top_keywords(spark, sf_dir):
    """Top 3 TF-IDF terms of every document."""
    return O.top_keywords(S.load_table(spark, sf_dir, "documents"), k=KEYWORDS_PER_DOC)


def page_skills(spark, sf_dir):
    """Skills of a posting page: its requirement text (list items, then
    paragraphs) -> the page's top TF-IDF terms across all pages."""
    req = O.page_fields(S.load_table(spark, sf_dir, "pages")) \
        .select(F.col("page_id").alias("doc_id"), F.col("requirements").alias("text"))
    return O.top_keywords(req, k=KEYWORDS_PER_DOC) \
        .select(F.col("doc_id").alias("page_id"), F.col("keywords").alias("skill"))


# -------------------------------------------------------------- streaming

def _stage_messages(spark, sf_dir, base: str) -> str:
    """Write the jobs' wire messages as JSON lines (one folder of files)."""
    path = f"{base}/messages"
    env = _envelope(spark, sf_dir)
    env.select("value").write.mode("overwrite").text(path)
    return path


def stream_ingest(spark, sf_dir):
    """JSON-lines stream -> parse -> per-batch lake folders -> current view."""
    base = run_dir(spark, "stream_ingest")
    src = _stage_messages(spark, sf_dir, base)
    ST.stream_ingest(spark, "text", {"maxFilesPerTrigger": str(STREAM_FILES_PER_TRIGGER)},
                     lake_path=f"{base}/lake", checkpoint=f"{base}/checkpoint", path=src)
    cur = O.lake_current(O.read_lake(spark, f"{base}/lake").drop("scraped_month"))
    return _lake_out(cur)


def stream_progress(spark, sf_dir):
    """What the engine's reports say that an ingest stream of good and broken messages received,
    rejected, quarantined and wrote; read back from the progress table."""
    base = run_dir(spark, "stream_progress")
    _messages(spark, sf_dir).select(F.col("value").cast("string").alias("value")).write.text(f"{base}/messages")
    ST.stream_ingest(spark, "text", {"maxFilesPerTrigger": str(STREAM_FILES_PER_TRIGGER)}, lake_path=f"{base}/lake",
                     checkpoint=f"{base}/checkpoint", path=f"{base}/messages", progress_path=f"{base}/progress")
    reports = ST.last_reports(ST.read_progress(spark, f"{base}/progress"))
    return reports.agg(F.sum("input_rows").alias("input_rows"),
                       *(F.sum(c).alias(c) for c in ("received", "rejected", "quarantined", "written")))


def dedup_stream(spark, sf_dir, runs: int = STREAM_RUNS) -> DataFrame:
    """Accepted keys of the staged arrivals, which come in `runs` parts; the stream is run,
    and resumed from its checkpoint, after each."""
    base = run_dir(spark, "stream_dedup")
    staged = FX.arrivals(S.jobs(spark, sf_dir), f"{base}/arrivals", runs)
    accepted = None
    for part in range(runs):
        come = spark.read.schema(f"{FX.ARRIVALS}, part int").parquet(staged).filter(F.col("part") == part)
        come.drop("part").write.mode("append").parquet(f"{base}/in")
        rows = S.read_stream(spark, "parquet", {}, path=f"{base}/in", schema=FX.ARRIVALS)
        accepted = ST.stream_dedup(rows, f"{base}/accepted", f"{base}/checkpoint")
    return accepted.select("set_start", "dedup_key", "arrived_at", "job_id")


def stream_dedup(spark, sf_dir):
    """Stream of messages -> each key's first arrival in its set, which opens with an
    arrival and expires 60 s later."""
    return dedup_stream(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "category_salary": category_salary,
    "ingest_parse": ingest_parse,
    "ingest_counts": ingest_counts,
    "event_props": event_props,
    "publish_envelope": publish_envelope,
    "skill_split": skill_split,
    "skill_join": skill_join,
    "scraped_at_parts": scraped_at_parts,
    "date_parse": date_parse,
    "date_reformat": date_reformat,
    "relative_expiry": relative_expiry,
    "category_clean": category_clean,
    "salary_parse": salary_parse,
    "salary_parse_tr": salary_parse_tr,
    "negotiable_filter": negotiable_filter,
    "stable_job_id": stable_job_id,
    "mart_clean": mart_clean,
    "high_water_mark": high_water_mark,
    "stored_mark": stored_mark,
    "incremental_load": incremental_load,
    "incremental_mart": incremental_mart,
    "location_count": location_count,
    "category_count": category_count,
    "dedup_batch": dedup_batch,
    "seen_keys_by_day": seen_keys_by_day,
    "dedup_against_seen": dedup_against_seen,
    "seen_probe": seen_probe,
    "merge_sources": merge_sources,
    "lake_layout": lake_layout,
    "lake_current": lake_current,
    "lake_newer": lake_newer,
    "lake_merged": lake_merged,
    "cap_per_group": cap_per_group,
    "page_fields": page_fields,
    "page_postings": page_postings,
    "top_keywords": top_keywords,
    "page_skills": page_skills,
    "stream_ingest": stream_ingest,
    "stream_dedup": stream_dedup,
    "stream_progress": stream_progress,
}
