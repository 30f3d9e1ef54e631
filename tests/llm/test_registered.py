"""Registered queries against their SQL, and the pipeline stage by stage."""

import pytest
from oracle_check import compare, duck_connect

import corpus_pipeline
from jobtide.llm.common import release, staged
from jobtide.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_sql(spark, name):
    result = compare(spark, duck_connect(SF), name, SF, QUERIES[name], ORACLE_SQL[name])
    assert result["status"] == "ok", result


OTHER_TABLES = {"op12_embedding_whitening"}  # tested in modules of their own


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL) - OTHER_TABLES))
def test_whole_table(spark, name):
    ids = [r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted(r.doc_id for r in QUERIES[name](spark, SF).collect()) == sorted(ids)


def test_every_stage_takes_what_the_one_before_kept(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "near_dedup", "decontamination", "mixing", "sharding"]
    met = []

    def watched(stage):
        def call(session, given, sf_dir):
            result = staged(stage(session, given, sf_dir), "watched")
            met.append((given, result))
            return result
        return call

    monkeypatch.setattr(corpus_pipeline, "STAGES", [(n, watched(f)) for n, f in corpus_pipeline.STAGES])
    last = corpus_pipeline.run(spark, SF)
    before = docs
    for given, result in met:
        assert sorted(map(tuple, given.collect())) == sorted(map(tuple, before.collect()))
        assert {r.doc_id for r in result.collect()} <= {r.doc_id for r in given.collect()}
        assert 0 < result.count() <= 3 * docs.count()
        assert result is met[-1][1] or result.columns == docs.columns
        before = result
    assert last is met[-1][1] and len(met) == 5


def test_stages_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0, name


def test_staged_tables_can_be_released(spark):
    import os

    release(spark)
    kept = staged(spark.range(5), "release-test")
    assert kept.count() == 5
    folder = kept.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    assert os.path.isdir(folder) and release(spark) == 1 and not os.path.exists(folder)
    assert release(spark) == 0
