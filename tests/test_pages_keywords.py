"""Listing caps, HTML fields and TF-IDF keywords against brute force."""

import math
import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from jobtide import functions as J
from jobtide import operators as O
from jobtide import sources as S
from jobtide.plans import fixtures as FX

SF = "/root/testdata/sf0.001"


def test_cap_listing_brute_force(spark):
    pages = S.load_table(spark, SF, "pages")
    got = sorted((r.host, r.page, r.page_id) for r in O.cap_listing(pages, 5, 2).collect())
    pdf = pages.select("page_id", "url").toPandas()
    pdf["host"] = pdf.url.str.extract(r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/:?#]+)")[0].str.lower()
    pdf["page"] = pdf.url.str.extract(r"[?&]page=(\d+)")[0].fillna(1).astype(int)
    pdf = pdf[pdf.page <= 5].sort_values("page_id")
    want = sorted((h, p, i) for (h, p), g in pdf.groupby(["host", "page"])
                  for i in g.page_id.head(2))
    assert got == want


def test_cap_plans_partial_limit(spark):
    pages = S.load_table(spark, SF, "pages")
    plan = O.cap_listing(pages, 5, 2)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_page_fields_hand_written(spark):
    html = ("<html><head><title>T &amp; co</title></head><body><ul><li><a href='/x'>one</a></li>"
            "<li>two</li><li>three</li></ul><h1>Head</h1><p>para <b>1</b></p><p>p2</p></body></html>")
    df = spark.createDataFrame([(1, "https://Blog.Example.com/x?page=3", html),
                                (2, "http://e.org/", "<title>Only title</title>")],
                               "page_id long, url string, html string")
    r = {x.page_id: x for x in O.page_fields(df).collect()}
    assert r[1].title == "Head" and r[1].third_item == "three" and r[1].host == "blog.example.com"
    assert r[1].requirements == "one, two, three, para 1, p2"
    assert r[2].title == "Only title" and r[2].third_item is None and r[2].requirements == ""


def test_tag_names_end_and_hidden_markup_is_skipped(spark):
    html = ("<head><link rel='a'><style>li{}</style><title> T </title></head><!-- <li>no</li> --><pre>code</pre>"
            "<h1>\n  Head &lt;A&gt;\n</h1><ul><li class='x'>one</li><li>two&nbsp;2</li></ul><script>'<li>no</li>'</script>"
            "<param name='p'><p>para</p>")
    df = spark.createDataFrame([(1, "http://e.org/", html), (2, None, None)], "page_id long, url string, html string")
    r = {x.page_id: x for x in O.page_fields(df).collect()}
    assert r[1].title == "Head <A>" and r[1].requirements == "one, two 2, para" and r[1].n_paragraphs == 1
    assert r[2].title is None and r[2].third_item is None


def test_top_keywords_with_a_term_in_every_document(spark):
    """The hot term joins from every document; results stay whole and it never ranks."""
    docs = spark.range(3000).select(F.col("id").alias("doc_id"),
                                    F.concat(F.lit("common common word"), F.col("id").cast("string")).alias("text"))
    got = {r.doc_id: r.keywords for r in O.top_keywords(docs, k=1).collect()}
    assert got == {i: f"word{i}" for i in range(3000)}


def test_top_keywords_brute_force(spark):
    docs = spark.createDataFrame([
        (1, "Spark spark SQL joins. Spark!"), (2, "SQL windows and joins"),
        (3, "Kafka streams; Kafka topics"), (4, ""), (5, "a b c"), (6, "C C R R C++ go c# + #"), (7, None)], "doc_id long, text string")
    got = {r.doc_id: r.keywords for r in O.top_keywords(docs, k=3).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    toks = {d: [t for t in re.split(r"[^\w+#]+|_", (s or "").lower()) if re.search(r"\w", t)] for d, s in texts.items()}
    dfreq = Counter(t for ts in toks.values() for t in set(ts))
    want = {}
    for d, ts in toks.items():
        c = Counter(ts)
        sc = sorted(((-round(n * math.log(len(texts) / dfreq[t]), 9), t)
                     for t, n in c.items()))
        want[d] = ", ".join(t for _, t in sc[:3])
    assert got == want


def test_only_rare_terms_and_the_best_common_ones_are_shuffled_after_the_count(spark):
    """Texts meet by document once; of terms that many documents have, k a document go on."""
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat_ws(
        " ", F.lit("all"), *(F.concat(F.lit(f"t{j}x"), F.pmod(F.xxhash64("id", F.lit(j)), F.lit(20)).cast("string"))
                             for j in range(30)), F.concat(F.lit("own"), F.col("id") % 3999)).alias("text")) \
        .unionByName(spark.createDataFrame([(7, "all all t0x1"), (None, "own1"), (8000, "+ #"), (8001, None)],
                                           "doc_id long, text string"))
    out = O.top_keywords(docs, k=3)
    got = {r.doc_id: r.keywords for r in out.collect()}
    tokens = {}
    for r in docs.collect():
        tokens.setdefault(r.doc_id, []).extend(t for t in (r.text or "").split() if t.strip("+#"))
    dfreq, n = Counter(t for ts in tokens.values() for t in set(ts)), docs.count()
    assert got == {d: ", ".join(t for _, t in sorted((-round(c * math.log(n / dfreq[t]), 9), t)
                                                     for t, c in Counter(ts).items())[:3]) for d, ts in tokens.items()}
    out = O.top_keywords(docs, k=3)
    out.write.format("noop").mode("overwrite").save()
    out.collect()
    plan = out._jdf.queryExecution().executedPlan()
    def rows(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return rows(node.executedPlan())
        if name in ("ShuffleQueryStage", "BroadcastQueryStage", "ResultQueryStage"):
            return rows(node.plan())
        below = [x for i in range(node.children().size()) for x in rows(node.children().apply(i))]
        return below + ([node.metrics().apply("shuffleRecordsWritten").value()] if name == "Exchange" else [])
    assert all(r <= 4 * docs.count() + 4 for r in rows(plan)), rows(plan)  # of 32 terms a document


def test_keywords_cover_every_document(spark):
    docs = S.load_table(spark, SF, "documents")
    out = O.top_keywords(docs)
    assert out.count() == docs.count()


def test_label_values(spark):
    from jobtide import functions as J
    html = ("<div><label> NGÀY ĐĂNG </label><p>01/07/2025</p></div>"
            "<div><label>NGÀNH NGHỀ</label><span>x</span><p><a>IT - Phần mềm</a></p></div>"
            "<div><label>KỸ NĂNG</label></div><p>not in the div</p>"
            "<div><label>Nested</label><div><div><p>no</p></div></div><div>x</div><p> yes &amp;\n so </p></div>")
    df = spark.createDataFrame([(html,), ("<p>none</p>",)], "html string")
    r = df.select(J.label_value("html", J.html.LABEL_POSTED).alias("p"),
                  J.label_value("html", J.html.LABEL_INDUSTRY).alias("i"),
                  J.label_value("html", J.html.LABEL_SKILLS).alias("s"),
                  J.label_value("html", "Nested").alias("n")).collect()
    assert (r[0].p, r[0].i, r[0].s, r[0].n) == ("01/07/2025", "IT - Phần mềm", None, "yes & so")
    assert (r[1].p, r[1].i, r[1].s) == (None, None, None)


def brute_plain(markup):
    text = re.sub(r"<[^>]*>", "", markup)
    for entity, character in J.html.ENTITIES:
        text = text.replace(entity, character)
    text = re.sub(r"[ \t\n\x0b\f\r]+", " ", text)
    return text.strip("".join(map(chr, range(0x21))))


@settings(max_examples=25, deadline=None, derandomize=True)
@given(st.lists(st.lists(st.sampled_from(["a", "é ", " ", "\t", "\n", "\x00", "\x1f", "<b>", "</b>", "<", ">", "&amp;", "&lt;", "&nbsp;",
                                          "&", " ", "x y"]), max_size=9).map("".join), min_size=1, max_size=40))
def test_plain_text_matches_brute_force(spark, pieces):
    df = spark.createDataFrame(list(enumerate(pieces)), "i long, m string")
    got = df.select("i", J.html.plain_text(F.col("m")).alias("t"),
                    J.extract_field(F.concat(F.lit("<p>"), "m", F.lit("</p>")), J.html.PARAGRAPH).alias("f")).collect()
    for r in got:
        assert r.t == brute_plain(pieces[r.i])
        assert r.f == (brute_plain(pieces[r.i]) or None)


def test_a_page_is_scanned_once_for_the_items_that_labels_share(spark):
    rows = FX.rendered_pages(S.jobs(spark, SF))
    plan = O.page_postings(rows, FX.LABEL_SOURCE)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(_h") == 2 and "Join" not in plan  # spans and list items
