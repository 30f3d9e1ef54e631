"""Field extraction from raw HTML pages with regex column expressions.

Each field is a label/element pattern; a missing match is null, and a field
may fall back to a second pattern (`coalesce`). Repeated elements are taken
with `regexp_extract_all` and indexed with `get` (0-based, null if absent).
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _c, collapse_ws, java_trim

# Detail-page labels of the source system (industry, posted
# date, skills).
LABEL_INDUSTRY, LABEL_POSTED, LABEL_SKILLS = "NGÀNH NGHỀ", "NGÀY ĐĂNG", "KỸ NĂNG"
# Labels in the list items of the other collector's boxes, and the
# heading of its requirements.
ITEM_POSTED, ITEM_INDUSTRY, ITEM_SALARY, ITEM_EXPIRY = "Ngày cập nhật", "Ngành nghề", "Lương", "Hết hạn nộp"
REQUIREMENTS = "Yêu Cầu Công Việc"

# (?s): '.' also matches newlines, so elements spanning lines are whole. A tag
# name ends at white space or '>': <li> is not <link>, <p> is not <pre>.
def element(tag: str, having: str = "") -> str:
    """Pattern of an element's content; `having` is a pattern its attributes must match."""
    attributes = rf"(?=[^>]*{having})" if having else ""
    return rf"(?s)<{tag}(?:\s{attributes}[^>]*)?>(.*?)</{tag}>" if not having \
        else rf"(?s)<{tag}\s{attributes}[^>]*>(.*?)</{tag}>"


H1, TITLE, LIST_ITEM, PARAGRAPH, LINK = map(element, ("h1", "title", "li", "p", "a"))
TAG = r"<[^>]*>"
HIDDEN = r"(?s)<(?:!--.*?--|(?i:(script|style))\b[^>]*>.*?</(?i:\1)\s*)>"
NOT_PLAIN = r"[<&]|\s\s|[^\S ]"  # tags, entities, white space other than single spaces
URL_HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/:?#]+)"
URL_PAGE = r"[?&]page=(\d+)"
# The entities that markup itself needs, `&amp;` last.
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"),
            ("&amp;", "&"))


def visible(html: Column | str) -> Column:
    """Markup without comments, scripts and style sheets."""
    return F.regexp_replace(_c(html), HIDDEN, "")


def plain_text(markup: Column) -> Column:
    """Text of a piece of markup: no tags, entities decoded, white space collapsed and trimmed.

    Most pieces are plain already, so one look decides whether there is more to do than trim.
    """
    text = F.regexp_replace(markup, TAG, "")
    for entity, character in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(character))
    return F.when(markup.rlike(NOT_PLAIN), java_trim(collapse_ws(text))).otherwise(java_trim(markup))


def once(value: Column, body) -> Column:
    """`body(value)` with the value computed once: inlined, it would be computed at each use."""
    return F.get(F.transform(F.array(value), body), 0)


def extract_field(html: Column | str, pattern: str, fallback: str | None = None) -> Column:
    """Text of the first group of `pattern`; '' -> null."""
    def one(p):
        text = once(F.regexp_extract(_c(html), p, 1), plain_text)
        return once(text, lambda t: F.nullif(t, F.lit("")))
    return one(pattern) if fallback is None else F.coalesce(one(pattern), one(fallback))


def extract_all_text(html: Column | str, pattern: str) -> Column:
    """Texts of all matches of `pattern` (group 1)."""
    return F.transform(F.regexp_extract_all(_c(html), F.lit(pattern), 1), plain_text)


def labelled_item(items: Column, texts: Column, label: str, inner: str = PARAGRAPH) -> Column:
    """Text of the first `inner` element of the first of the list items whose text has `label`.

    `items` and `texts` are the items' markup and text, which every label of a page shares.
    """
    place = F.array_position(F.transform(texts, lambda x: x.contains(label)), True)
    return extract_field(F.get(items, (place - 1).cast("int")), inner)


def nth_item(html: Column | str, pattern: str, i: int) -> Column:
    """The i-th (0-based) match of a repeated element, else null."""
    return F.get(extract_all_text(html, pattern), i)


def url_host(url: Column | str) -> Column:
    """Lower-case host of an absolute URL, else null."""
    return F.nullif(F.lower(F.regexp_extract(_c(url), URL_HOST, 1)), F.lit(""))


def url_page(url: Column | str) -> Column:
    """The `page` query parameter as int; absent -> 1."""
    n = F.nullif(F.regexp_extract(_c(url), URL_PAGE, 1), F.lit("")).try_cast("int")
    return F.coalesce(n, F.lit(1))


def _block(depth: int) -> str:
    """Pattern of a whole <div>, with others inside it to `depth` more levels."""
    inside = r"[^<]++|<(?!/?div\b)" + (f"|{_block(depth - 1)}" if depth else "")
    return rf"<div\b[^>]*>(?:{inside})*+</div>"


def label_value(html: Column | str, label: str, nested: int = 4) -> Column:
    """Text of the first <p> after a <label> of this text, among its later siblings.

    Sibling blocks between the two are stepped over whole (<div>s nested to
    `nested` levels), and the end of the label's own parent ends the search.
    Missing -> null.
    """
    between = rf"(?:[^<]++|<(?!/?div\b|p[\s>])|{_block(nested)})*+"
    pattern = rf"(?s)<label(?:\s[^>]*)?>\s*{re.escape(label)}\s*</label>{between}<p(?:\s[^>]*)?>(.*?)</p>"
    return extract_field(html, pattern)
