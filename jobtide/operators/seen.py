"""The seen set as a store that a run probes: only the row groups that may hold its keys are read.

Keys are stored with a hash, sorted by it, with Parquet bloom filters on it. A
run of few distinct keys (the source system collects some tens at a time) asks
for their hashes by equality, so files and row groups whose range or bloom filter
excludes all of them are skipped: what is read follows the run, not the history.
Beyond FEW_KEYS a run reads the stored keys and joins, as it would touch every
row group anyway. Either way the anti join is on the whole key, so a shared hash
does no harm.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .dedup import drop_seen
from .lake import read_or_empty

FEW_KEYS = 200                # distinct keys of a run that are looked up by hash
ROW_GROUP_BYTES = 8 << 20     # small row groups: the unit that a probe skips
KEYS_PER_GROUP = 100_000      # expected by a bloom filter
STORED = "dedup_key string, key_hash long"


def key_hash(key: str = "dedup_key") -> Column:
    return F.xxhash64(key)


def store_seen(keys: DataFrame, path: str, row_group_bytes: int = ROW_GROUP_BYTES) -> None:
    """Append the distinct `dedup_key`s to the store, in ranges of their hash.

    The distinct step has a partial aggregate, so a hot key is reduced before the
    shuffle. Null keys are not stored.
    """
    rows = keys.filter("dedup_key IS NOT NULL").select("dedup_key").distinct().withColumn("key_hash", key_hash())
    (rows.repartitionByRange("key_hash").sortWithinPartitions("key_hash")
     .write.mode("append").option("parquet.block.size", row_group_bytes)
     .option("parquet.bloom.filter.enabled#key_hash", "true")
     .option("parquet.bloom.filter.expected.ndv#key_hash", KEYS_PER_GROUP).parquet(path))


def read_seen(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, path, STORED)


def any_of(hashes: Sequence[int]) -> Column:
    """Equality with one of the hashes, as alternatives, which reach the bloom filters; a long list would
    be pushed as a range."""
    terms = [F.col("key_hash") == F.lit(h) for h in hashes]
    while len(terms) > 1:  # a balanced tree
        terms = [reduce(or_, terms[k:k + 2]) for k in range(0, len(terms), 2)]
    return terms[0]


def probed(spark: SparkSession, path: str, run: DataFrame) -> DataFrame:
    """The stored keys that can match the rows of `run`."""
    hashes = [r["h"] for r in run.filter("dedup_key IS NOT NULL").select(key_hash().alias("h")).distinct()
              .limit(FEW_KEYS + 1).collect()]
    stored = read_seen(spark, path)
    if len(hashes) > FEW_KEYS:
        return stored
    return stored.filter(any_of(sorted(hashes)) if hashes else F.lit(False))


def unseen(spark: SparkSession, path: str, run: DataFrame) -> DataFrame:
    """The rows of `run` whose key is not in the store; rows without a key are unseen."""
    return drop_seen(run, probed(spark, path, run), keys=["dedup_key"])
