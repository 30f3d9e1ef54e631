"""Property test: the Spark salary parser against a plain-Python brute force
of the written rules (SURVEY §2.11), on generated salary texts."""

import re

from hypothesis import given, settings, HealthCheck
from hypothesis import strategies as st

from jobtide import functions as J

A = re.ASCII  # Java regex: \\s and \\d are ASCII, (?i) is ASCII-only


def jtrim(s):
    return re.sub(r"^[\x00-\x20]+|[\x00-\x20]+$", "", s)


def brute(text, variant):
    if text is None or text == "":
        return (None, None, None, None)
    t = jtrim(re.sub(r"\s+", " ", text.lower(), flags=A))
    if "thương lượng" in t or "cạnh tranh" in t:
        return (None, None, None, None)
    usd = "usd" in t or "$" in t
    if variant:
        marked = "tr" in t or "triệu" in t
        mult, unit = (1e6, "VND") if marked else ((1.0, "USD") if usd else (1.0, "VND"))
        s = t
        for p in (",", "₫", "vnd|vnđ|usd|/tháng", r"\$", r"(?i)(từ|tới|~|>)"):
            s = re.sub(p, "", s, flags=A)
    else:
        mult, unit = (1.0, "USD") if usd else (1e6, "VND")
        s = re.sub(r"(?i)(từ|tới|~|>)", "", re.sub(r"[₫,]|vnd|vnđ|usd|/tháng|\$", "", t, flags=A),
                   flags=A)
    s = jtrim(s)
    num = r"(\d+(\.\d+)?)"
    m = re.search(num + r"[^\d]+" + num, s, flags=A)
    if m:
        lo, hi = float(m.group(1)) * mult, float(m.group(3)) * mult
        return (lo, hi, (lo + hi) / 2.0, unit)
    m = re.search(r"trên\s*" + num, s, flags=A)
    if m:
        v = float(m.group(1)) * mult
        return (v, None, v, unit)
    m = re.search(r"dưới\s*" + num, s, flags=A)
    if m:
        v = float(m.group(1)) * mult
        return (None, v, v, unit)
    m = re.search(num, s, flags=A)
    if m:
        v = float(m.group(1)) * mult
        return (v, v, v, unit)
    return (None, None, None, unit)


TOKENS = ["Trên", "trên", "Dưới", "Tới", "Từ", "tr", "Tr", "triệu", "TRIỆU", "VND", "vnđ", "USD",
          "$", "-", "~", ">", "/tháng", "₫", ",", ".", "Thương lượng", "thương lượng", "Cạnh tranh",
          "hoa hồng", " ", "  ", "\t", "0", "7", "15", "1.5", "20,000,000", "1,000", "999"]
salary_text = st.one_of(st.none(), st.just(""),
                        st.lists(st.sampled_from(TOKENS), min_size=1, max_size=8).map("".join))


@settings(max_examples=8, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
@given(st.lists(salary_text, min_size=60, max_size=60))
def test_parser_matches_brute_force(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    p = J.with_salary_columns(df, "s")
    v = J.with_salary_columns(p, "s", True, ("vl", "vh", "va", "vu"))
    rows = v.orderBy("i").collect()
    for r, t in zip(rows, texts):
        assert (r.low, r.high, r.avg, r.unit) == brute(t, False), t
        assert (r.vl, r.vh, r.va, r.vu) == brute(t, True), t


def brute_category(text):
    if text is None or text == "":
        return None
    tokens = [jtrim(x) for x in re.split(r"[>/,|\-]", text.lower())]
    tokens = [x for x in tokens if x]
    return tokens[0] if tokens else None


CAT_TOKENS = [">", "/", ",", "|", "-", " ", "\t", "\n", "IT", "Phần mềm", "Kế toán", "Full", "time",
              "Marketing", "Data", " ", "x"]
category_text = st.one_of(st.none(), st.just(""),
                          st.lists(st.sampled_from(CAT_TOKENS), min_size=1, max_size=7).map("".join))


@settings(max_examples=8, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
@given(st.lists(category_text, min_size=60, max_size=60))
def test_category_matches_split_rule(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    rows = df.select("i", J.category_clean("s").alias("c")).orderBy("i").collect()
    for r, t in zip(rows, texts):
        assert r.c == brute_category(t), repr(t)
