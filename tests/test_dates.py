"""createdAt parts, dd/MM/yyyy parsing, relative expiry goldens."""

import datetime as dt

from pyspark.sql import functions as F

from jobtide import functions as J


def test_created_at_goldens(spark):
    df = spark.createDataFrame([(0, [2025, 7, 1, 9, 30, 5, 123456789]), (1, [2025, 7, 1, 9, 30]),
                                (2, None)], "i int, a array<int>")
    rows = df.orderBy("i").select(J.timestamp_from_parts("a").alias("d"),
                                  J.timestamp_from_parts("a", strict=True).alias("s")).collect()
    assert rows[0]["d"] == rows[0]["s"] == dt.datetime(2025, 7, 1, 9, 30, 5)
    assert rows[1]["d"] == dt.datetime(2025, 7, 1, 9, 30, 0) and rows[1]["s"] is None
    assert rows[2]["d"] is None


def test_parts_round_trip(spark):
    ts = [dt.datetime(2025, 7, 1, 0, 0), dt.datetime(2025, 7, 1, 9, 30, 5),
          dt.datetime(2025, 7, 1, 9, 30, 5, 250000)]
    df = spark.createDataFrame([(t,) for t in ts], "t timestamp")
    out = df.select(J.timestamp_to_parts("t").alias("p")).collect()
    assert [r.p for r in out] == [[2025, 7, 1, 0, 0], [2025, 7, 1, 9, 30, 5],
                                  [2025, 7, 1, 9, 30, 5, 250000000]]
    back = df.select(J.timestamp_from_parts(J.timestamp_to_parts("t")).alias("b")).collect()
    assert [r.b for r in back] == [t.replace(microsecond=0) for t in ts]


def test_wire_date_goldens(spark):
    df = spark.createDataFrame([(0, "01/07/2025"), (1, "31/02/2025"), (2, "1/7/2025"), (3, None)],
                               "i int, s string")
    got = [r[0] for r in df.orderBy("i").select(J.parse_wire_date("s")).collect()]
    assert got == [dt.datetime(2025, 7, 1), None, None, None]


def test_relative_expiry_goldens(spark):
    texts = ["Hết hạn trong 10 ngày", "Hết hạn trong 1 tháng", "Hết hạn trong 2 tuần", "Không rõ",
             "", None, "99999999999 ngày"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string") \
        .withColumn("posted", F.to_date(F.lit("2025-01-31")))
    got = [r[0] for r in df.orderBy("i").select(
        J.format_wire_date(J.relative_expiry("posted", "t"))).collect()]
    assert got == ["10/02/2025", "28/02/2025", "14/02/2025", "02/03/2025", None, None,
                   "31/01/2025"]


def test_mart_date_text_forms(spark):
    df = spark.createDataFrame([(dt.datetime(2025, 7, 1, 23, 0),)], "t timestamp")
    r = df.select(J.mdy_text("t"), J.mdy_text_from_iso(F.col("t").cast("string")),
                  J.mart_date("t"), J.mdy_text_from_iso(F.lit("garbage"))).first()
    assert tuple(r) == ("07/01/2025", "07/01/2025", dt.date(2025, 7, 1), None)
