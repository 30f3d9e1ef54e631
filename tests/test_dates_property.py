"""Property tests: relative expiry and the dedup key against brute force."""

import calendar
import datetime as dt
import re
import unicodedata

from hypothesis import given, settings, HealthCheck
from hypothesis import strategies as st

from jobtide import functions as J


def add_months(d, n):
    m = d.month - 1 + n
    y, m = d.year + m // 12, m % 12 + 1
    return dt.date(y, m, min(d.day, calendar.monthrange(y, m)[1]))


def brute_expiry(posted, text):
    if posted is None or text is None or text == "":
        return None
    t = text.lower().strip()
    m = re.search(r"(\d+)", t, flags=re.ASCII)
    n = int(m.group(1)) if m and int(m.group(1)) <= 2**31 - 1 else 0
    if "ngày" in t:
        return posted + dt.timedelta(days=n)
    if "tháng" in t:
        return add_months(posted, n)
    if "tuần" in t:
        return posted + dt.timedelta(weeks=n)
    return posted + dt.timedelta(days=30)


# One number per text (results stay inside the years Python can hold); the
# 11-digit number overflows an int and counts as 0.
number = st.one_of(st.just(""), st.integers(0, 999).map(str), st.just("99999999999"))
exp_text = st.one_of(
    st.none(), st.just(""),
    st.tuples(st.sampled_from(["Hết hạn trong ", "", " ", "còn "]), number,
              st.sampled_from([" ngày", " tháng", " tuần", " NGÀY", "", " x", " tháng ngày"]))
    .map("".join))
posted = st.one_of(st.none(), st.dates(min_value=dt.date(1995, 1, 1), max_value=dt.date(2030, 12, 31)))


@settings(max_examples=6, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(posted, exp_text), min_size=60, max_size=60))
def test_relative_expiry_matches_brute_force(spark, cases):
    df = spark.createDataFrame([(i, p, t) for i, (p, t) in enumerate(cases)], "i int, p date, t string")
    rows = df.select("i", J.relative_expiry("p", "t").alias("e")).orderBy("i").collect()
    for r, (p, t) in zip(rows, cases):
        assert r.e == brute_expiry(p, t), (p, t)


def brute_key(title, url):
    t = re.sub(r"^[\x00-\x20]+|[\x00-\x20]+$", "", (title or "").lower())
    t = unicodedata.normalize("NFC", re.sub(r"\s+", " ", t, flags=re.ASCII))
    u = re.sub(r"^[\x00-\x20]+|[\x00-\x20]+$", "", (url or "").lower())
    return f"job:{t}::{u}"


TITLE_TOKENS = ["Kỹ sư", "Kỹ sư", "DATA", " ", "  ", "\t", "\n", "Engineer", "é", "é", "1"]
title = st.one_of(st.none(), st.lists(st.sampled_from(TITLE_TOKENS), max_size=6).map("".join))
url = st.one_of(st.none(), st.sampled_from(["HTTPS://Jobs.example/7 ", " u", "x/Y", ""]))


@settings(max_examples=6, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(title, url), min_size=60, max_size=60))
def test_dedup_key_matches_brute_force(spark, cases):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(cases)], "i int, a string, b string")
    rows = df.select("i", J.dedup_key("a", "b").alias("k")).orderBy("i").collect()
    for r, (a, b) in zip(rows, cases):
        assert r.k == brute_key(a, b), (a, b)


stamps = st.datetimes(min_value=dt.datetime(1970, 1, 1), max_value=dt.datetime(2100, 12, 31))


@settings(max_examples=5, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
@given(st.lists(stamps, min_size=60, max_size=60))
def test_time_stamp_parts_round_trip(spark, ts):
    """timestamp -> producer array (trailing zero seconds/nanos dropped) -> timestamp."""
    df = spark.createDataFrame([(i, t) for i, t in enumerate(ts)], "i int, t timestamp")
    rows = df.select("i", J.timestamp_to_parts("t").alias("p"),
                     J.timestamp_from_parts(J.timestamp_to_parts("t")).alias("b")).orderBy("i").collect()
    for r, t in zip(rows, ts):
        want = [t.year, t.month, t.day, t.hour, t.minute]
        if t.microsecond:
            want += [t.second, t.microsecond * 1000]
        elif t.second:
            want += [t.second]
        assert r.p == want, t
        assert r.b == t.replace(microsecond=0), t
