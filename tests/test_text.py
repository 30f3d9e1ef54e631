"""Category, skills, negotiable filter, dedup key goldens."""

import unicodedata

from pyspark.sql import functions as F

from jobtide import functions as J
from jobtide import operators as O


def one_col(spark, values, expr, typ="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {typ}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


def test_category_goldens(spark):
    got = one_col(spark, ["> IT - Phần mềm / Data", "Marketing, Sales", "Kế toán|Kiểm toán",
                          "Full-time", " - ", None, "", "\t IT \n"], J.category_clean)
    assert got == ["it", "marketing", "kế toán", "full", None, None, None, "it"]


def test_java_trim_strips_control_chars(spark):
    assert one_col(spark, ["\t\n a b \x0b", "  ", None], J.java_trim) == ["a b", "", None]


def test_skill_goldens(spark):
    got = one_col(spark, [None, "", "a,  b,c", "a, ,b"], J.skill_split)
    assert got == [[], [""], ["a", "b", "c"], ["a", "", "b"]]
    joined = one_col(spark, [None, "", "a,  b,c"], lambda c: J.skill_join(J.skill_split(c)))
    assert joined == ["", "", "a,b,c"]


def test_negotiable_filter(spark):
    df = spark.createDataFrame([(s,) for s in ["thương lượng", "20 tr", "Thương lượng",
                                               "Cạnh tranh", None]], "salary string")
    kept = sorted(r[0] for r in O.negotiable_filter(df).collect())
    assert kept == ["20 tr", "thương lượng"]


def test_dedup_key_golden_and_nfc_twin(spark):
    nfc_title = "Kỹ sư dữ liệu"
    nfd_title = unicodedata.normalize("NFD", nfc_title)
    assert nfd_title != nfc_title
    df = spark.createDataFrame([
        ("  Data   Engineer 1", "HTTPS://Jobs.example/7 "),
        (nfc_title, "u"), (nfd_title, "u"), (None, None)], "title string, url string")
    keys = [r[0] for r in df.select(J.dedup_key("title", "url")).collect()]
    assert keys[0] == "job:data engineer 1::https://jobs.example/7"
    assert keys[1] == keys[2] == "job:" + nfc_title.lower() + "::u"
    assert keys[3] == "job:::"


def test_stable_id_is_sha256(spark):
    import hashlib
    df = spark.createDataFrame([("job:a::b",)], "k string")
    assert df.select(J.stable_id("k")).first()[0] == hashlib.sha256(b"job:a::b").hexdigest()
