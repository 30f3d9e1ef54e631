"""The corpus pipeline: stages over `documents`, each written as Parquet and read again.

Every stage takes what the one before it kept and returns the columns of
documents; the last gives each document's shard and its place in it. The
first stage is a trained model, which SQL cannot express; the stages are
tested one by one against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from jobtide.llm import decontamination, minhash_dedup, mixing, sharding, toxicity
from jobtide.llm.common import staged, table


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents under the toxicity score of 0.7."""
    return toxicity.clean_documents(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: 5-word shingles, Jaccard of 80 %."""
    return minhash_dedup.keep_first(docs, words=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item: 5-word shingles, 80 %."""
    return decontamination.uncontaminated(docs, table(spark, sf_dir, "benchmark"), words=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as the seeded selection passes over it."""
    return mixing.mixed_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row of the mix in one of 16 shards of near-equal bytes."""
    return sharding.sharded(docs, shards=16)


STAGES = [
    ("toxicity", reject_toxic),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("sharding", shard),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
