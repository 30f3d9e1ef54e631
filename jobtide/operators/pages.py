"""Raw pages: cap items per listing page, take posting fields from HTML.

Capping is `row_number() <= n` over a window; Spark plans it with a partial
WindowGroupLimit before the shuffle, so each map task forwards at most n
rows per group and a host holding a third of all pages costs no more than
any other in the final step.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import functions as J


def cap_per_group(df: DataFrame, group: Sequence[str], order: Sequence, n: int,
                  rank_col: str = "pos") -> DataFrame:
    """The first n rows of each group in `order` (with their 1-based position)."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)


def with_listing_position(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """Add the listing host and page number taken from the URL."""
    return pages.withColumns({"host": J.url_host(url_col), "page": J.url_page(url_col)})


def cap_listing(pages: DataFrame, max_pages: int, per_page: int,
                id_col: str = "page_id") -> DataFrame:
    """Listing caps: pages 1..max_pages of each host, first per_page items of each."""
    listed = with_listing_position(pages).filter(F.col("page") <= max_pages)
    return cap_per_group(listed, ["host", "page"], [F.col(id_col).asc()], per_page)


def page_fields(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """Posting fields from whole HTML pages.

    title: <h1> text, falling back to <title>; third_item: third <li>, else
    null; requirements: list items then paragraphs, joined with ', '.
    """
    html = F.col("_visible")
    # Stage the repeated elements as columns: each pattern scans the page once
    # (a column used several times is not inlined into each use).
    staged = pages.select("page_id", "url", J.html.visible(html_col).alias("_visible")).select(
        "page_id",
        J.url_host("url").alias("host"),
        J.extract_field(html, J.html.H1, fallback=J.html.TITLE).alias("title"),
        J.extract_all_text(html, J.html.LIST_ITEM).alias("_items"),
        J.extract_all_text(html, J.html.PARAGRAPH).alias("_paras"),
    )
    items, paras = F.col("_items"), F.col("_paras")
    return staged.select(
        "page_id", "host", "title",
        F.get(items, 2).alias("third_item"),
        F.size(items).cast("bigint").alias("n_items"),
        F.size(paras).cast("bigint").alias("n_paragraphs"),
        F.array_join(F.concat(items, paras), ", ").alias("requirements"),
    )


# The two detail page forms: where each field of a posting is.
SPAN_INFO = J.html.element("span", 'class="info"')
LABEL_FORM = {
    "title": J.html.element("h1", 'name="title"'),
    "company": J.html.element("a", 'class="company"'),
    "salary": J.html.element("span", 'class="salary"'),
}
BOX_FORM = {
    "title": J.html.element("h1", 'class="title"'),
    "company": J.html.element("a", 'class="employer'),
    "location": r'(?s)<div\s(?=[^>]*class="map")[^>]*>(?:(?!</div>).)*?<p(?:\s[^>]*)?>\s*<a(?:\s[^>]*)?>(.*?)</a>',
}
REQUIREMENT_SECTION = (rf'(?s)<div\s(?=[^>]*class="detail-row)[^>]*>((?:(?!</?div\b|{J.html.REQUIREMENTS}).)*+'
                       rf"{J.html.REQUIREMENTS}(?:(?!</?div\b).)*+)</div>")


def requirements_text(html: Column) -> Column:
    """List items, then paragraphs, of the requirement section only."""
    section = F.regexp_extract(html, REQUIREMENT_SECTION, 1)
    return F.array_join(F.concat(J.extract_all_text(section, J.html.LIST_ITEM),
                                 J.extract_all_text(section, J.html.PARAGRAPH)), ", ")


def page_postings(pages: DataFrame, label_source: str, id_col: str = "job_id", html_col: str = "html") -> DataFrame:
    """Detail pages (id, url, source, html) -> the collected fields of each posting.

    Pages of `label_source` have labels with paragraphs and info spans (the
    first is the expiry text, the third the location); the others have boxes of
    labelled list items. A missing field is null. `expired_at` is dd/MM/yyyy.
    """
    seen = pages.select(id_col, "url", "source", J.html.visible(html_col).alias("_h"))
    html, labels = F.col("_h"), F.col("source") == label_source
    posted = J.label_value(html, J.html.LABEL_POSTED)
    # What several fields use is staged: each pattern scans a page once.
    spans = seen.withColumns({
        "_spans": F.when(labels, J.extract_all_text(html, SPAN_INFO)), "_posted": F.when(labels, posted),
        "_items": F.when(~labels, F.regexp_extract_all(html, F.lit(J.html.LIST_ITEM), F.lit(1)))}) \
        .withColumn("_texts", F.transform("_items", J.html.plain_text))
    items, texts = F.col("_items"), F.col("_texts")
    expiry = J.format_wire_date(J.relative_expiry(J.parse_wire_date("_posted"), F.get("_spans", 0)))
    by_label = {
        **{name: J.extract_field(html, p) for name, p in LABEL_FORM.items()},
        "location": F.nullif(F.get("_spans", 2), F.lit("")),
        "category": J.label_value(html, J.html.LABEL_INDUSTRY),
        "posted_at": F.col("_posted"), "expired_at": expiry,
        "skill": J.label_value(html, J.html.LABEL_SKILLS),
    }
    by_box = {
        **{name: J.extract_field(html, p) for name, p in BOX_FORM.items()},
        "salary": J.labelled_item(items, texts, J.html.ITEM_SALARY),
        "category": J.labelled_item(items, texts, J.html.ITEM_INDUSTRY, J.html.LINK),
        "posted_at": J.labelled_item(items, texts, J.html.ITEM_POSTED),
        "expired_at": J.labelled_item(items, texts, J.html.ITEM_EXPIRY),
        "skill": F.nullif(requirements_text(html), F.lit("")),
    }
    return spans.select(id_col, "url", "source", *(
        F.when(labels, by_label[name]).otherwise(by_box[name]).alias(name)
        for name in ("title", "company", "location", "salary", "category", "posted_at", "expired_at", "skill")))
