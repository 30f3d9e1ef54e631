"""Inputs that Spark derives from the postings view: messages, detail pages, arrivals.

They grow with the given tables. What the registered queries read back from
them is known from the postings, so that SQL can state the expected result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import sources as S
from ..functions import html as H

LABEL_SOURCE = "VietnamWorks"  # whose pages have the label form
# Arrivals: PER_SECOND postings a second, a pause of PAUSE seconds after every BURST
# seconds; every fourth posting is sent again AGAIN seconds later.
PER_SECOND, BURST, PAUSE, AGAIN = 5, 100, 37, 20
ARRIVALS = "arrived_at timestamp, job_id string, title string, url string"


def messages(jobs: DataFrame, envelope: DataFrame) -> DataFrame:
    """The jobs' messages as binary values, with broken ones among them: truncated
    JSON, JSON without an id, and records without a source."""
    kind = F.col("job_id").cast("bigint") % 50
    broken = F.when(kind == 0, F.concat(F.lit('{"jobId": "'), "job_id")) \
        .when(kind == 1, F.lit('{"title": "no id"}')) \
        .when(kind == 2, F.concat(F.lit('{"jobId": "q'), "job_id", F.lit('", "source": "", "createdAt": [2024,1,1,1,1]}')))
    return (envelope.select("value")
            .unionByName(jobs.select(broken.alias("value")).filter("value IS NOT NULL"))
            .select(F.col("value").cast("binary").alias("value")))


def rendered_pages(jobs: DataFrame) -> DataFrame:
    """A detail page per posting, in its source's form, with what real pages put around
    the fields: links, comments, scripts, nested blocks, entities, line ends."""
    rec = S.jobs_as_records(jobs, "expire_text")

    def shown(name):
        text = F.coalesce(F.col(name), F.lit(""))
        for character, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
            text = F.replace(text, F.lit(character), F.lit(entity))
        return text

    def page(*parts):
        return F.concat(*(shown(p[1:]) if p.startswith("=") else F.lit(p) for p in parts))

    head = ('<html><head><link rel="icon" href="/li"><style>p { color: red }</style><script>"<h1>no</h1>"</script>'
            f"</head><body><!-- <label>{H.LABEL_POSTED}</label><p>no</p> --><pre>no</pre><ul><li>Menu</li></ul>")
    labels = page(
        head, '<h1 name="title">\n ', "=title", '\n</h1><a class="company" href="#">', "=company",
        '</a><span class="info">', "=expire_text", '</span><span class="info">x</span><span class="info"> ', "=location",
        ' </span><span class="salary"><b>', "=salary", "</b></span>",
        f"<div><label> {H.LABEL_POSTED} </label><div><div><p>no</p></div></div><p>", "=postedAt", "</p></div>",
        f"<div><label>{H.LABEL_INDUSTRY}</label> <i>x</i><p><a>", "=category", "</a></p></div>",
        f"<div><label>{H.LABEL_SKILLS}</label>", "<p>", "=skill", "</p></div><p>end</p></body></html>")
    boxes = page(
        head, '<h1 class="title">', "=title", '</h1><a class="employer job" href="#">', "=company",
        '</a><div class="map"><b>x</b><p><a>', "=location", f"</a></p></div><div class='box'><ul><li><b>{H.ITEM_POSTED}</b><p>",
        "=postedAt", f"</p></li><li>{H.ITEM_INDUSTRY}: <a>", "=category",
        f"</a><a>other</a></li></ul></div><div><ul><li>{H.ITEM_SALARY}<p> ",
        "=salary", f"</p></li><li>{H.ITEM_EXPIRY} <p>", "=expiredAt",
        f'</p></li></ul></div><div class="detail-row x"><h2>{H.REQUIREMENTS}</h2><ul><li>', "=skill",
        "</li></ul></div><p>end</p></body></html>")
    form = F.when(F.col("source") == LABEL_SOURCE, labels).otherwise(boxes)
    return rec.select(F.col("jobId").alias("job_id"), "url", "source", form.alias("html"))


def arrivals(jobs: DataFrame, path: str, parts: int) -> str:
    """Write the postings' arrivals, in folders `part=0 ..` of equal spans of time; returns `path`."""
    number = F.col("job_id").cast("bigint")
    second = F.floor(number / PER_SECOND)
    at = (second + PAUSE * F.floor(second / BURST)) * 1000 + number % PER_SECOND * (1000 // PER_SECOND) + number % 3
    sent = F.when(number % 4 == 0, F.array(at, at + AGAIN * 1000)).otherwise(F.array(at))
    rows = jobs.withColumn("at", F.explode(sent)).select(
        F.timestamp_millis("at").alias("arrived_at"), "job_id", "title", "url", "at")
    span = (rows.agg(F.max("at")).first()[0] or 0) // parts + 1
    rows.withColumn("part", F.floor(F.col("at") / span).cast("int")).drop("at") \
        .write.partitionBy("part").parquet(path)
    return path
