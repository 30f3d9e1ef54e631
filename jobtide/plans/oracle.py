"""DuckDB SQL oracles for the registered queries.

Each statement runs on the given tables as DuckDB views and recomputes the
query's answer independently of Spark (RE2 regexes, DuckDB date math and
list functions). Column names match the Spark outputs.
"""

from __future__ import annotations

from ..sources.tables import FIXTURE_MARK, JOBS_SQL
from . import fixtures as FX

MARK = f"TIMESTAMP '{FIXTURE_MARK}'"
DEFAULT_MARK = "TIMESTAMP '2000-01-01 00:00:00'"


def jtrim(x: str) -> str:
    """Strip chars <= U+0020 at both ends."""
    return rf"regexp_replace({x}, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')"


def collapse(x: str) -> str:
    return rf"regexp_replace({x}, '\s+', ' ', 'g')"


def category_sql(x: str) -> str:
    toks = rf"regexp_split_to_array(lower({x}), '[>/,|\-]')"
    return (f"CASE WHEN {x} IS NULL OR {x} = '' THEN NULL ELSE "
            f"list_filter(list_transform({toks}, lambda t: {jtrim('t')}), lambda t: t <> '')[1] END")


def skill_list_sql(x: str) -> str:
    return rf"CASE WHEN {x} IS NULL THEN []::VARCHAR[] ELSE string_split_regex({x}, ',\s*') END"


def expiry_sql(posted: str, text: str) -> str:
    t = jtrim(f"lower({text})")
    n = rf"COALESCE(TRY_CAST(NULLIF(regexp_extract({t}, '(\d+)', 1), '') AS INTEGER), 0)"
    d = f"CAST({posted} AS DATE)"
    return (f"CASE WHEN {posted} IS NULL OR {text} IS NULL OR {text} = '' THEN NULL "
            f"WHEN contains({t}, 'ngày') THEN {d} + {n} "
            f"WHEN contains({t}, 'tháng') THEN CAST({d} + to_months({n}) AS DATE) "
            f"WHEN contains({t}, 'tuần') THEN {d} + 7 * {n} "
            f"ELSE {d} + 30 END")


def key_sql(title: str, url: str) -> str:
    t = collapse(jtrim(f"lower(coalesce({title}, ''))"))
    u = jtrim(f"lower(coalesce({url}, ''))")
    return f"'job:' || nfc_normalize({t}) || '::' || {u}"


def created_at_sql(ts: str) -> str:
    base = f"[year({ts}), month({ts}), day({ts}), hour({ts}), minute({ts})]"
    frac = f"(epoch_us({ts}) % 1000000)"
    return (f"CASE WHEN {frac} > 0 THEN list_concat({base}, [second({ts}), {frac} * 1000]) "
            f"WHEN second({ts}) > 0 THEN list_concat({base}, [second({ts})]) ELSE {base} END")


NUM = r"(\d+(\.\d+)?)"
RANGE_RE = NUM + r"[^\d]+" + NUM
ABOVE_RE = r"trên\s*" + NUM
BELOW_RE = r"dưới\s*" + NUM


def salary_ctes(base: str, col: str = "salary", variant: bool = False, out: str = "sal") -> str:
    """CTEs that add s_low, s_high, s_avg, s_unit to every row of `base`."""
    st = jtrim(collapse(f"lower({col})"))
    if variant:
        marked = "(contains(_st, 'tr') OR contains(_st, 'triệu'))"
        mult = f"CASE WHEN {marked} THEN 1.0e6 ELSE 1.0 END"
        unit = f"CASE WHEN {marked} THEN 'VND' WHEN _usd THEN 'USD' ELSE 'VND' END"
        stripped = "_st"
        for pat in (",", "₫", "vnd|vnđ|usd|/tháng", r"\$", "(?i)(từ|tới|~|>)"):
            stripped = f"regexp_replace({stripped}, '{pat}', '', 'g')"
    else:
        mult = "CASE WHEN _usd THEN 1.0 ELSE 1.0e6 END"
        unit = "CASE WHEN _usd THEN 'USD' ELSE 'VND' END"
        stripped = (r"regexp_replace(regexp_replace(_st, '[₫,]|vnd|vnđ|usd|/tháng|\$', '', 'g'), "
                    r"'(?i)(từ|tới|~|>)', '', 'g')")
    num = lambda pat, g: f"TRY_CAST(regexp_extract(_s, '{pat}', {g}) AS DOUBLE) * _mult"
    return f"""
{out}0 AS (SELECT *, {st} AS _st FROM {base}),
{out}1 AS (SELECT *, (contains(_st, 'usd') OR contains(_st, '$')) AS _usd,
                 (contains(_st, 'thương lượng') OR contains(_st, 'cạnh tranh')) AS _neg FROM {out}0),
{out}2 AS (SELECT *, {mult} AS _mult, {unit} AS _unit, {jtrim(stripped)} AS _s FROM {out}1),
{out}3 AS (SELECT *,
   regexp_matches(_s, '{RANGE_RE}') AS _hr, regexp_matches(_s, '{ABOVE_RE}') AS _ha,
   regexp_matches(_s, '{BELOW_RE}') AS _hb, regexp_matches(_s, '{NUM}') AS _hs,
   {num(RANGE_RE, 1)} AS _rl, {num(RANGE_RE, 3)} AS _rh, {num(ABOVE_RE, 1)} AS _av,
   {num(BELOW_RE, 1)} AS _bv, {num(NUM, 1)} AS _sv FROM {out}2),
{out} AS (SELECT *,
   CASE WHEN {col} IS NULL OR {col} = '' OR _neg THEN NULL WHEN _hr THEN _rl WHEN _ha THEN _av
        WHEN _hb THEN NULL WHEN _hs THEN _sv END AS s_low,
   CASE WHEN {col} IS NULL OR {col} = '' OR _neg THEN NULL WHEN _hr THEN _rh WHEN _ha THEN NULL
        WHEN _hb THEN _bv WHEN _hs THEN _sv END AS s_high,
   CASE WHEN {col} IS NULL OR {col} = '' OR _neg THEN NULL WHEN _hr THEN (_rl + _rh) / 2.0
        WHEN _ha THEN _av WHEN _hb THEN _bv WHEN _hs THEN _sv END AS s_avg,
   CASE WHEN {col} IS NULL OR {col} = '' OR _neg THEN NULL ELSE _unit END AS s_unit
 FROM {out}3)"""


JOBS = f"jobs AS ({JOBS_SQL})"
LAKE = f"""lake AS (
 SELECT job_id, title, company, location, salary, {skill_list_sql('skill')} AS skill,
        category, url, source, CAST(scraped_at AS TIMESTAMP) AS scraped_at,
        CAST({expiry_sql('posted_at', 'expire_text')} AS TIMESTAMP) AS expired_at,
        CAST(posted_at AS TIMESTAMP) AS posted_at
 FROM jobs)"""
RECORDS = f"""rec AS (
 SELECT job_id AS jobId, title, company, location, salary, skill, category,
        strftime({expiry_sql('posted_at', 'expire_text')}, '%d/%m/%Y') AS expiredAt,
        strftime(posted_at, '%d/%m/%Y') AS postedAt, url, source,
        {created_at_sql('CAST(scraped_at AS TIMESTAMP)')} AS createdAt
 FROM jobs)"""
KEYED = f"k AS (SELECT *, {key_sql('title', 'url')} AS dedup_key, CAST(scraped_at AS DATE) AS day FROM lake)"
NOT_NEGOTIABLE = "NOT (contains(salary, 'Thương lượng') OR contains(salary, 'Cạnh tranh'))"


def mart_ctes(base: str, out: str = "mart") -> str:
    return salary_ctes(base, out=f"{out}_s") + f""",
{out} AS (
 SELECT job_id, title, company, location, s_avg AS salary, s_unit AS salaryunit,
        {category_sql('category')} AS category,
        CAST(CAST(expired_at AS DATE) AS VARCHAR) AS expired_at,
        CAST(CAST(posted_at AS DATE) AS VARCHAR) AS posted_at,
        array_to_string(skill, ',') AS skill, url, source,
        strftime(scraped_at, '%Y-%m-%d %H:%M:%S') AS scraped_at
 FROM {out}_s WHERE {NOT_NEGOTIABLE})"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


LAKE_OUT = ("job_id, title, company, location, salary, len(skill) AS n_skills, "
            "array_to_string(skill, '|') AS skills, category, url, source, scraped_at, "
            "expired_at, posted_at")

HWM = _with(JOBS, LAKE, "lake_b AS (SELECT * FROM lake WHERE scraped_at <= " + MARK + ")",
            mart_ctes("lake_b", "mart_b"),
            "hwm AS (SELECT COALESCE(try_strptime(MAX(scraped_at), '%Y-%m-%d %H:%M:%S'), "
            f"{DEFAULT_MARK}) AS mark FROM mart_b)")

HOST = r"nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/:?#]+)', 1)), '')"
PAGE = r"COALESCE(TRY_CAST(NULLIF(regexp_extract(url, '[?&]page=(\d+)', 1), '') AS INTEGER), 1)"


def plain_sql(x: str) -> str:
    """Text of markup: no tags, entities decoded, white space collapsed and trimmed."""
    x = f"regexp_replace({x}, '<[^>]*>', '', 'g')"
    for entity, character in (("nbsp", " "), ("lt", "<"), ("gt", ">"), ("quot", '"'), ("#39", "''"), ("apos", "''"),
                              ("amp", "&")):
        x = f"replace({x}, '&{entity};', '{character}')"
    return jtrim(collapse(x))


VISIBLE = (r"regexp_replace(html, '(?is)<!--.*?-->|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>', "
           "'', 'g')")


def _all_text(pattern: str) -> str:
    return f"list_transform(regexp_extract_all({VISIBLE}, '{pattern}', 1), lambda x: {plain_sql('x')})"


def _field(pattern: str) -> str:
    return f"nullif({plain_sql(f'regexp_extract({VISIBLE}, {chr(39)}{pattern}{chr(39)}, 1)')}, '')"


H1 = r"(?s)<h1(?:\s[^>]*)?>(.*?)</h1>"
TITLE = r"(?s)<title(?:\s[^>]*)?>(.*?)</title>"
LI = r"(?s)<li(?:\s[^>]*)?>(.*?)</li>"
P = r"(?s)<p(?:\s[^>]*)?>(.*?)</p>"


def shown(x: str) -> str:
    """A source column as a page shows it."""
    return f"nullif({jtrim(collapse(x))}, '')"


def keywords_sql(docs: str, prelude: str = "", id_out: str = "doc_id", kw_out: str = "keywords") -> str:
    """TF-IDF top 3 per document of `docs(doc_id, text)` (raw-count tf)."""
    return prelude + rf"""
toks AS (
  SELECT doc_id AS doc,
         list_filter(regexp_split_to_array(lower(text), '[^\p{{L}}\p{{N}}+#]+'), lambda t: regexp_matches(t, '[\p{{L}}\p{{N}}]')) AS toks
  FROM {docs}),
ex AS (SELECT doc, unnest(toks) AS term FROM toks),
tf AS (SELECT doc, term, count(*) AS n FROM ex GROUP BY doc, term),
dfq AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
nd AS (SELECT CAST(count(*) AS DOUBLE) AS n_docs FROM {docs}),
sc AS (SELECT tf.doc, tf.term, CAST(tf.n AS DOUBLE) * ln(nd.n_docs / dfq.df) AS score
       FROM tf JOIN dfq ON tf.term = dfq.term, nd),
rk AS (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY round(score, 9) DESC, term) AS rk FROM sc),
kw AS (SELECT doc, string_agg(term, ', ' ORDER BY rk) AS keywords FROM rk WHERE rk <= 3 GROUP BY doc)
SELECT d.doc_id AS {id_out}, COALESCE(kw.keywords, '') AS {kw_out}
FROM {docs} d LEFT JOIN kw ON d.doc_id = kw.doc"""


ORACLE_SQL: dict[str, str] = {
    "category_salary": _with(JOBS, salary_ctes("jobs")) + f"""
SELECT category, unit, count(*) AS postings, count(s_avg) AS with_salary, avg(s_avg) AS avg_salary
FROM (SELECT {category_sql('category')} AS category, s_avg, s_unit AS unit FROM sal)
GROUP BY category, unit""",

    "ingest_parse": _with(JOBS, LAKE) + f"SELECT {LAKE_OUT} FROM lake",

    "ingest_counts": _with(JOBS) + """
SELECT count(*) + count(*) FILTER (k <= 2) AS received, count(*) FILTER (k <= 1) AS rejected,
       count(*) FILTER (k = 2) AS quarantined, count(*) AS written
FROM (SELECT CAST(job_id AS BIGINT) % 50 AS k FROM jobs)""",

    "stream_progress": _with(JOBS) + """
SELECT count(*) + count(*) FILTER (k <= 2) AS input_rows, count(*) + count(*) FILTER (k <= 2) AS received,
       count(*) FILTER (k <= 1) AS rejected, count(*) FILTER (k = 2) AS quarantined, count(*) AS written
FROM (SELECT CAST(job_id AS BIGINT) % 50 AS k FROM jobs)""",

    "event_props": "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",

    "publish_envelope": _with(JOBS, RECORDS) + """
SELECT category AS key,
       to_json(struct_pack(jobId := jobId, title := title, company := company, location := location,
                           salary := salary, skill := skill, category := category,
                           expiredAt := expiredAt, postedAt := postedAt, url := url,
                           source := source, createdAt := createdAt)) AS value
FROM rec""",

    "skill_split": _with(JOBS) + f"""
SELECT job_id, skill, len({skill_list_sql('skill')}) AS n_skills,
       array_to_string({skill_list_sql('skill')}, '|') AS skills FROM jobs""",

    "skill_join": _with(JOBS, LAKE) + "SELECT job_id, array_to_string(skill, ',') AS skill FROM lake",

    "scraped_at_parts": _with(JOBS, RECORDS) + """
SELECT r.jobId AS job_id, array_to_string(r.createdAt, ',') AS created_at,
       CAST(j.scraped_at AS TIMESTAMP) AS scraped_at,
       CASE WHEN len(r.createdAt) >= 6 THEN date_trunc('second', CAST(j.scraped_at AS TIMESTAMP)) END
         AS scraped_at_strict
FROM rec r JOIN jobs j ON r.jobId = j.job_id""",

    "date_parse": _with(JOBS, RECORDS) + """
SELECT jobId AS job_id, postedAt, expiredAt,
       try_strptime(postedAt, '%d/%m/%Y') AS posted_at, try_strptime(expiredAt, '%d/%m/%Y') AS expired_at
FROM (SELECT * REPLACE (CASE CAST(jobId AS BIGINT) % 9 WHEN 0 THEN '31/02/2024' WHEN 1 THEN 'soon' WHEN 2 THEN ''
      ELSE postedAt END AS postedAt) FROM rec)""",

    "date_reformat": _with(JOBS, LAKE) + """
SELECT job_id, strftime(posted_at, '%m/%d/%Y') AS posted_mdy,
       strftime(try_strptime(substr(strftime(expired_at, '%Y-%m-%d %H:%M:%S'), 1, 10), '%Y-%m-%d'),
                '%m/%d/%Y') AS expired_mdy,
       CAST(CAST(posted_at AS DATE) AS VARCHAR) AS posted_date,
       CAST(CAST(expired_at AS DATE) AS VARCHAR) AS expired_date
FROM lake""",

    "relative_expiry": _with(JOBS) + f"""
SELECT job_id, expire_text, strftime(d, '%d/%m/%Y') AS expired_text, CAST(d AS VARCHAR) AS expired_date
FROM (SELECT job_id, expire_text, {expiry_sql('posted_at', 'expire_text')} AS d FROM jobs)""",

    "category_clean": _with(JOBS) + f"""
SELECT job_id, category AS category_raw, {category_sql('category')} AS category FROM jobs""",

    "salary_parse": _with(JOBS, "base AS (SELECT job_id, salary FROM jobs)", salary_ctes("base")) + """
SELECT job_id, salary, s_low AS low, s_high AS high, s_avg AS avg, s_unit AS unit FROM sal""",

    "salary_parse_tr": _with(JOBS, "base AS (SELECT job_id, salary FROM jobs)",
                             salary_ctes("base", variant=True)) + """
SELECT job_id, salary, s_low AS low, s_high AS high, s_avg AS avg, s_unit AS unit FROM sal""",

    "negotiable_filter": _with(JOBS) + f"SELECT job_id, salary FROM jobs WHERE {NOT_NEGOTIABLE}",

    "stable_job_id": _with(JOBS) + f"""
SELECT job_id, dedup_key, sha256(dedup_key) AS stable_id
FROM (SELECT job_id, {key_sql('title', 'url')} AS dedup_key FROM jobs)""",

    "mart_clean": _with(JOBS, LAKE, mart_ctes("lake")) + "SELECT * FROM mart",

    "high_water_mark": HWM + "SELECT mark FROM hwm",

    "stored_mark": HWM + "SELECT mark FROM hwm",

    "incremental_load": HWM.rstrip() + ",\n" + """
new AS (SELECT * FROM lake WHERE scraped_at > (SELECT mark FROM hwm))
SELECT job_id, source, title, scraped_at FROM new""",

    "incremental_mart": HWM.rstrip() + ",\n" + "new AS (SELECT * FROM lake WHERE scraped_at > (SELECT mark FROM hwm)),\n"
    + mart_ctes("new", "mart_n").lstrip() + "\nSELECT * FROM mart_n",

    "location_count": _with(JOBS, LAKE) + """
SELECT location, count(*) AS count FROM lake WHERE NOT contains(location, 'Hết hạn') GROUP BY location""",

    "category_count": _with(JOBS, LAKE, mart_ctes("lake")) + """
SELECT category, count(*) AS count FROM mart GROUP BY category""",

    "dedup_batch": _with(JOBS, LAKE, KEYED) + """
SELECT CAST(day AS VARCHAR) AS day, dedup_key, job_id, scraped_at, n_copies
FROM (SELECT day, dedup_key, job_id, scraped_at,
             row_number() OVER (PARTITION BY day, dedup_key ORDER BY scraped_at, job_id) AS rn,
             count(*) OVER (PARTITION BY day, dedup_key) AS n_copies
      FROM k)
WHERE rn = 1""",

    "seen_keys_by_day": _with(JOBS, LAKE, KEYED) + f"""
SELECT DISTINCT CAST(day AS VARCHAR) AS day, dedup_key FROM k WHERE scraped_at <= {MARK}""",

    "dedup_against_seen": _with(JOBS, LAKE, KEYED) + f"""
SELECT n.job_id, n.dedup_key, n.scraped_at FROM k n
WHERE n.scraped_at > {MARK}
  AND NOT EXISTS (SELECT 1 FROM k s WHERE s.scraped_at <= {MARK} AND s.dedup_key = n.dedup_key)""",

    "seen_probe": _with(JOBS, LAKE, KEYED) + """
SELECT n.job_id, n.dedup_key, n.scraped_at FROM k n
WHERE n.day = (SELECT max(day) FROM k)
  AND NOT EXISTS (SELECT 1 FROM k s WHERE s.day < n.day AND s.dedup_key = n.dedup_key)""",

    "merge_sources": _with(JOBS) + """
SELECT job_id, source, title, url, company FROM jobs WHERE source IN ('VietnamWorks', 'Careerviet')""",

    "lake_layout": _with(JOBS, LAKE) + """
SELECT job_id, source, scraped_at, strftime(scraped_at, '%Y-%m') AS scraped_month FROM lake""",

    "lake_current": _with(JOBS, LAKE) + """
SELECT job_id, source, scraped_at, title, batch_id
FROM (SELECT *, row_number() OVER (PARTITION BY source, scraped_at, job_id ORDER BY batch_id DESC) AS rn
      FROM (SELECT job_id, source, scraped_at, title, CAST(0 AS BIGINT) AS batch_id FROM lake
            UNION ALL
            SELECT job_id, source, scraped_at, title || ' (updated)', CAST(1 AS BIGINT) FROM lake))
WHERE rn = 1""",

    "lake_newer": _with(JOBS, LAKE) + """
SELECT job_id, source, title, scraped_at, CAST(1 AS BIGINT) AS batch_id
FROM lake WHERE CAST(job_id AS BIGINT) % 3 = 0""",

    "lake_merged": _with(JOBS, LAKE) + """
SELECT job_id, source, scraped_at, CASE WHEN CAST(job_id AS BIGINT) % 2 = 0 THEN title || ' (updated)' ELSE title END AS title,
       len(skill) AS n_skills, array_to_string(skill, '|') AS skills, posted_at,
       CASE WHEN CAST(job_id AS BIGINT) % 2 = 0 THEN CAST(1 AS BIGINT) ELSE CAST(0 AS BIGINT) END AS batch_id
FROM lake WHERE CAST(job_id AS BIGINT) % 2 = 0 OR CAST(job_id AS BIGINT) % 3 > 0""",

    "page_postings": _with(JOBS, RECORDS) + f"""
SELECT r.jobId AS job_id, r.url, r.source, {shown('r.title')} AS title, {shown('r.company')} AS company,
       {shown('r.location')} AS location, {shown('r.salary')} AS salary, {shown('r.category')} AS category,
       r.postedAt AS posted_at, r.expiredAt AS expired_at, {shown('r.skill')} AS skill
FROM rec r""",

    # A day's first set starts with its first arrival; each further one with the first
    # arrival after the one before has expired.
    "stream_dedup": _with(JOBS).replace("WITH", "WITH RECURSIVE", 1) + f"""
, sent AS (
  SELECT *, unnest(CASE WHEN n % 4 = 0 THEN [a, a + {FX.AGAIN} * 1000] ELSE [a] END) AS t
  FROM (SELECT *, (n // {FX.PER_SECOND} + {FX.PAUSE} * (n // {FX.PER_SECOND} // {FX.BURST})) * 1000
               + n % {FX.PER_SECOND} * {1000 // FX.PER_SECOND} + n % 3 AS a
        FROM (SELECT *, CAST(job_id AS BIGINT) AS n FROM jobs))),
ticks AS (SELECT DISTINCT t, t // 86400000 AS day FROM sent),
starts AS (
  SELECT day, min(t) AS s FROM ticks GROUP BY day
  UNION ALL
  SELECT starts.day, min(t) FROM starts JOIN ticks ON ticks.day = starts.day AND t >= s + 60000 GROUP BY starts.day),
placed AS (
  SELECT s, t, job_id, {key_sql('title', 'url')} AS dedup_key
  FROM sent ASOF JOIN starts ON sent.t // 86400000 = starts.day AND sent.t >= starts.s)
SELECT epoch_ms(s)::TIMESTAMP AS set_start, dedup_key, epoch_ms(t)::TIMESTAMP AS arrived_at, job_id FROM (
  SELECT *, row_number() OVER (PARTITION BY s, dedup_key ORDER BY t, job_id) AS rn FROM placed)
WHERE rn = 1""",

    "cap_per_group": f"""
SELECT host, CAST(page AS BIGINT) AS page, page_id, pos
FROM (SELECT host, page, page_id, row_number() OVER (PARTITION BY host, page ORDER BY page_id) AS pos
      FROM (SELECT page_id, {HOST} AS host, {PAGE} AS page FROM pages)
      WHERE page <= 5)
WHERE pos <= 2""",

    "page_fields": f"""
SELECT page_id, {HOST} AS host,
       COALESCE({_field(H1)}, {_field(TITLE)}) AS title,
       {_all_text(LI)}[3] AS third_item,
       len({_all_text(LI)}) AS n_items,
       len({_all_text(P)}) AS n_paragraphs,
       array_to_string(list_concat({_all_text(LI)}, {_all_text(P)}), ', ') AS requirements
FROM pages""",

    "top_keywords": keywords_sql("documents", prelude="WITH"),

    "stream_ingest": _with(JOBS, LAKE) + f"SELECT {LAKE_OUT} FROM lake",

    "page_skills": keywords_sql(
        "pf", prelude=f"""WITH pf AS (
  SELECT page_id AS doc_id,
         array_to_string(list_concat({_all_text(LI)}, {_all_text(P)}), ', ') AS text
  FROM pages),""", id_out="page_id", kw_out="skill"),
}
