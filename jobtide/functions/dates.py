"""Date and time columns: array parts, dd/MM/yyyy text, relative expiry.

Spark 4 runs with ANSI mode on, where `to_timestamp` on bad text and
out-of-range `getItem` throw; these helpers use `try_to_timestamp`, `get`
and `try_cast` so bad input becomes null instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _c

# Fixed values that must equal the source system's formats and words.
WIRE_DATE_FORMAT = "dd/MM/yyyy"
MART_TEXT_DATE_FORMAT = "MM/dd/yyyy"
TS_TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss"
UNIT_DAY, UNIT_MONTH, UNIT_WEEK = "ngày", "tháng", "tuần"
DEFAULT_EXPIRY_DAYS = 30


def timestamp_from_parts(col: Column | str, strict: bool = False) -> Column:
    """[y, M, d, h, m, s, (nanos)] int array -> timestamp in whole seconds.

    A missing seconds element means zero, as the producer omits it then;
    strict=True gives null for it. Impossible or missing parts give null.
    """
    parts = [F.get(_c(col), i) for i in range(6)]
    if not strict:
        parts[5] = F.coalesce(parts[5], F.lit(0))
    return F.try_make_timestamp(*parts[:5], parts[5].cast("decimal(16,6)"))


def timestamp_to_parts(col: Column | str) -> Column:
    """timestamp -> producer array form [y, M, d, h, m(, s(, nanos))].

    Trailing zero seconds and nanos are left out, as the producer's JSON
    mapper does.
    """
    ts = _c(col)
    sec_frac = F.date_part(F.lit("SECOND"), ts)          # decimal seconds with micros
    sec = F.floor(sec_frac).cast("int")
    nanos = ((sec_frac - F.floor(sec_frac)) * F.lit(1000000000)).cast("int")
    base = F.array(F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.minute(ts))
    return F.when(ts.isNull(), F.lit(None).cast("array<int>")) \
        .when(nanos > 0, F.concat(base, F.array(sec, nanos))) \
        .when(sec > 0, F.concat(base, F.array(sec))) \
        .otherwise(base)


def collected_now() -> Column:
    """The collection time stamp in the producer's array form (whole query
    uses one `current_timestamp()`, so every row of a run gets the same)."""
    return timestamp_to_parts(F.current_timestamp())


def parse_wire_date(col: Column | str) -> Column:
    """`dd/MM/yyyy` text -> timestamp; malformed or impossible dates -> null."""
    return F.try_to_timestamp(_c(col), F.lit(WIRE_DATE_FORMAT))


def format_wire_date(col: Column | str) -> Column:
    """date/timestamp -> `dd/MM/yyyy` text."""
    return F.date_format(_c(col), WIRE_DATE_FORMAT)


def timestamp_text(col: Column | str) -> Column:
    """timestamp -> `yyyy-MM-dd HH:mm:ss` text (session time zone)."""
    return F.date_format(_c(col), TS_TEXT_FORMAT)


def mart_date(col: Column | str) -> Column:
    """timestamp -> date in the session zone.

    The source system went through `MM/dd/yyyy` text and back; the date is
    the same, so the round trip is skipped.
    """
    return F.to_date(_c(col))


def mdy_text(col: Column | str) -> Column:
    """timestamp -> `MM/dd/yyyy` text; null -> null."""
    return F.date_format(_c(col), MART_TEXT_DATE_FORMAT)


def mdy_text_from_iso(col: Column | str) -> Column:
    """Text whose first 10 chars are `yyyy-MM-dd` -> `MM/dd/yyyy`; bad -> null."""
    head = F.substring(_c(col).cast("string"), 1, 10)
    return F.date_format(F.try_to_timestamp(head, F.lit("yyyy-MM-dd")), MART_TEXT_DATE_FORMAT)


def first_int(col: Column | str) -> Column:
    """First run of digits as int; none or overflow -> 0."""
    digits = F.regexp_extract(_c(col), r"(\d+)", 1)
    return F.coalesce(F.nullif(digits, F.lit("")).try_cast("int"), F.lit(0))


def relative_expiry(posted: Column | str, text: Column | str) -> Column:
    """Expiry date from a posted date and text like 'Hết hạn trong 10 ngày'.

    posted + n days / n months / n weeks by the words ngày / tháng / tuần,
    tested in that order (n = first number, 0 if none); any other text -> +30
    days. Month steps clamp to the month end. null posted, null or empty text
    -> null.
    """
    p = F.to_date(_c(posted))
    raw = _c(text)
    t = F.lower(raw)  # trimming cannot change a word or digit test
    n = first_int(t)
    return F.when(p.isNull() | raw.isNull() | (raw == F.lit("")), F.lit(None).cast("date")) \
        .when(t.contains(UNIT_DAY), F.date_add(p, n)) \
        .when(t.contains(UNIT_MONTH), F.add_months(p, n)) \
        .when(t.contains(UNIT_WEEK), F.date_add(p, F.try_multiply(n, F.lit(7)))) \
        .otherwise(F.date_add(p, F.lit(DEFAULT_EXPIRY_DAYS)))
