"""Format/options readers and writers round-trip on file formats."""

import datetime as dt


from jobtide import functions as J
from jobtide import sources as S


def test_write_read_round_trip(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    for fmt in ("parquet", "json", "orc"):
        S.write(df, fmt, path=f"{tmp_dir}/{fmt}", mode="overwrite")
        back = S.read(spark, fmt, path=f"{tmp_dir}/{fmt}", schema=df.schema)
        assert sorted(tuple(r) for r in back.collect()) == [(1, "a"), (2, "b")], fmt


def test_partitioned_write(spark, tmp_dir):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "id long, p string")
    S.write(df, "parquet", path=tmp_dir + "/t", partition_by=["p"])
    assert {r.p for r in S.read(spark, "parquet", path=tmp_dir + "/t").collect()} == {"x", "y"}


def test_kafka_options_and_empty_publish(spark):
    opts = S.kafka_source_options("host:9094", "job-topic", max_offsets_per_trigger=100,
                                  min_partitions=64)
    assert opts == {"kafka.bootstrap.servers": "host:9094", "subscribe": "job-topic",
                    "startingOffsets": "earliest", "maxOffsetsPerTrigger": "100",
                    "minPartitions": "64"}
    empty = spark.createDataFrame([], "key string, value string")
    assert S.kafka_publish(empty, "host:9094", "job-topic") is False  # no-op, no connection


def test_collection_stamp_and_ids(spark):
    r = spark.range(3).select(J.collected_now().alias("c"), J.random_id().alias("u")).collect()
    assert len({x.u for x in r}) == 3 and len({tuple(x.c) for x in r}) == 1
    assert dt.datetime(*r[0].c[:5]).year >= 2024
