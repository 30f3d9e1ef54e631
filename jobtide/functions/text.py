"""String columns: trimming, whitespace, Unicode NFC, categories, skills, keys.

All of these are built-in Spark expressions (whole-stage codegen) except
`nfc`, which Spark has no built-in for; it is an Arrow-batched pandas UDF.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values that must equal the source system's rules.
# Separators of the category "first phrase": > / , | -
CATEGORY_SEPARATORS = r"[>/,|\-]"
# Skills arrive as one comma list: comma, then optional whitespace.
SKILL_SEPARATOR = r",\s*"
# A Java String.trim() strips every char <= U+0020 at both ends;
# Spark's trim() strips spaces only, btrim() the characters it is given.
_JAVA_TRIM = "".join(map(chr, range(0x21)))
_FIRST_CATEGORY_TOKEN = r"^[>/,|\-\x00-\x20]*([^>/,|\-]*)"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def java_trim(col: Column | str) -> Column:
    """Strip all control chars and spaces (<= U+0020) at both ends."""
    return F.btrim(_c(col), F.lit(_JAVA_TRIM))


def collapse_ws(col: Column | str) -> Column:
    """Replace each run of whitespace with one space."""
    return F.regexp_replace(_c(col), r"\s+", " ")


@F.pandas_udf(T.StringType())
def _nfc_udf(s: pd.Series) -> pd.Series:
    # unicodedata's quick check returns text already in NFC (e.g. ASCII) as is.
    return s.str.normalize("NFC")


def nfc(col: Column | str) -> Column:
    """Unicode canonical composition (NFC)."""
    return _nfc_udf(_c(col))


def contains_any(col: Column | str, phrases) -> Column:
    """True when the text contains any phrase (case-sensitive); null stays null."""
    col = _c(col)
    cond = None
    for p in phrases:
        cond = col.contains(p) if cond is None else (cond | col.contains(p))
    return cond


def category_clean(col: Column | str) -> Column:
    """First phrase of a free-text category, lower case.

    lower -> split on > / , | - -> trim each token -> drop empties -> first.
    null, empty or no token -> null.
    """
    # One regex: skip separators and blanks (empty tokens), take the first
    # token up to the next separator, strip its trailing blanks.
    first = F.regexp_extract(F.lower(_c(col)), _FIRST_CATEGORY_TOKEN, 1)
    return F.nullif(java_trim(first), F.lit(""))


def skill_split(col: Column | str) -> Column:
    """Comma list -> array; null -> []; '' -> [''] (empty items are kept)."""
    col = _c(col)
    return F.when(col.isNull(), F.array().cast("array<string>")) \
        .otherwise(F.split(col, SKILL_SEPARATOR))


def skill_join(col: Column | str) -> Column:
    """Array -> comma list; null items are skipped; null array -> ''."""
    return F.concat_ws(",", _c(col))


def dedup_key(title: Column | str, url: Column | str) -> Column:
    """Normalized posting key: job:<title>::<url>.

    title: lower, trim, collapse whitespace, NFC. url: lower, trim.
    A null title or url counts as empty.
    """
    t = collapse_ws(java_trim(F.lower(F.coalesce(_c(title), F.lit("")))))
    u = java_trim(F.lower(F.coalesce(_c(url), F.lit(""))))
    # Provably non-null: no `isnotnull(key)` filter gets inferred from joins
    # on the key (such a filter would re-run the UDF below a repartition).
    return F.concat(F.lit("job:"), F.coalesce(nfc(t), F.lit("")), F.lit("::"), u)


def stable_id(key: Column | str) -> Column:
    """Deterministic posting id: SHA-256 hex of the dedup key."""
    return F.sha2(_c(key), 256)


def random_id() -> Column:
    """Random UUID per row (one collector's id scheme). Not stable across
    recomputation -- prefer `stable_id` wherever a retry may recompute rows."""
    return F.expr("uuid()")
