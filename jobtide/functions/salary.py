"""Free-text salary -> low, high, avg (double) and unit (string).

Native column expressions only (no UDF). The parse is staged as a few
projections: the normalized and the stripped text are each computed once
(Catalyst does not inline a non-trivial column that is used more than
once), and each pattern is one `regexp_extract` whose empty result means
"no match" -- so every row runs each regex once.

Rules (first match wins, after normalization and token stripping):
  range  "A <non-digits> B"      -> low=A, high=B, avg=(A+B)/2
  above  "trên N"                -> low=N, high=null, avg=N
  below  "dưới N"                -> low=null, high=N, avg=N
  single "N"                     -> low=high=avg=N
  none                           -> all null, unit kept
null / empty / negotiable text   -> all null including unit.
A decimal single such as "1.5" reads as the range 1-5 (the range pattern
backtracks over the dot); this is kept on purpose.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import _c, collapse_ws, java_trim

# Fixed values that must equal the source system's rules.
NEGOTIABLE_WORDS = ("thương lượng", "cạnh tranh")
STRIP_TOKENS = r"[₫,]|vnd|vnđ|usd|/tháng|\$"
STRIP_WORDS = r"(?i)(từ|tới|~|>)"
VARIANT_STRIP_STEPS = (",", "₫", "vnd|vnđ|usd|/tháng", r"\$", STRIP_WORDS)
NUM = r"(\d+(\.\d+)?)"
RANGE_RE = NUM + r"[^\d]+" + NUM
ABOVE_RE = r"trên\s*" + NUM
BELOW_RE = r"dưới\s*" + NUM
SINGLE_RE = NUM
MILLION = 1.0e6

_T = "__sal_text"
_S = "__sal_stripped"
_USD, _NEG, _MARK = "__sal_usd", "__sal_neg", "__sal_marked"
_R1, _R3, _AB, _BE, _SI = "__sal_r1", "__sal_r3", "__sal_above", "__sal_below", "__sal_single"
_TEMPS = [_T, _S, _USD, _NEG, _MARK, _R1, _R3, _AB, _BE, _SI]


def normalize_text(col: Column | str) -> Column:
    """lower, collapse whitespace, strip chars <= U+0020."""
    return java_trim(collapse_ws(F.lower(_c(col))))


def with_salary_columns(df: DataFrame, col: str = "salary", million_only_if_marked: bool = False,
                        names: tuple[str, str, str, str] = ("low", "high", "avg", "unit")
                        ) -> DataFrame:
    """Add the four parsed salary columns (see module doc).

    million_only_if_marked=False: amounts are millions of VND unless the text
    mentions usd or $ (then USD, x1). True: the variant where amounts are x1e6
    only when the text mentions "tr"/"triệu", else usd/$ -> USD, else VND x1.
    """
    raw = F.col(col)
    out = df.withColumn(_T, normalize_text(raw))
    t = F.col(_T)
    flags = {_USD: t.contains("usd") | t.contains("$"),
             _NEG: t.contains(NEGOTIABLE_WORDS[0]) | t.contains(NEGOTIABLE_WORDS[1]),
             _MARK: (t.contains("tr") | t.contains("triệu")) if million_only_if_marked
             else F.lit(False)}
    if million_only_if_marked:
        stripped = t
        for pat in VARIANT_STRIP_STEPS:
            stripped = F.regexp_replace(stripped, pat, "")
    else:
        stripped = F.regexp_replace(F.regexp_replace(t, STRIP_TOKENS, ""), STRIP_WORDS, "")
    out = out.withColumns({**flags, _S: java_trim(stripped)})
    s = F.col(_S)
    out = out.withColumns({_R1: F.regexp_extract(s, RANGE_RE, 1),
                           _R3: F.regexp_extract(s, RANGE_RE, 3),
                           _AB: F.regexp_extract(s, ABOVE_RE, 1),
                           _BE: F.regexp_extract(s, BELOW_RE, 1),
                           _SI: F.regexp_extract(s, SINGLE_RE, 1)})

    usd, marked = F.col(_USD), F.col(_MARK)
    if million_only_if_marked:
        mult = F.when(marked, F.lit(MILLION)).otherwise(F.lit(1.0))
        unit = F.when(marked, F.lit("VND")).when(usd, F.lit("USD")).otherwise(F.lit("VND"))
    else:
        mult = F.when(usd, F.lit(1.0)).otherwise(F.lit(MILLION))
        unit = F.when(usd, F.lit("USD")).otherwise(F.lit("VND"))

    def num(c):
        return F.col(c).try_cast("double") * mult

    def found(c):
        return F.col(c) != F.lit("")

    null_d = F.lit(None).cast("double")
    empty = raw.isNull() | (raw == F.lit("")) | F.col(_NEG)
    low = F.when(empty, null_d).when(found(_R1), num(_R1)).when(found(_AB), num(_AB)) \
        .when(found(_BE), null_d).when(found(_SI), num(_SI))
    high = F.when(empty, null_d).when(found(_R1), num(_R3)).when(found(_AB), null_d) \
        .when(found(_BE), num(_BE)).when(found(_SI), num(_SI))
    avg = F.when(empty, null_d).when(found(_R1), (num(_R1) + num(_R3)) / F.lit(2.0)) \
        .when(found(_AB), num(_AB)).when(found(_BE), num(_BE)).when(found(_SI), num(_SI))
    unit_col = F.when(empty, F.lit(None).cast("string")).otherwise(unit)
    return out.withColumns(dict(zip(names, (low, high, avg, unit_col)))).drop(*_TEMPS)
