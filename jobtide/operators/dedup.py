"""Posting dedup: normalized key, per-day seen sets, anti-membership.

Scale notes
- Batch dedup is a hash aggregate on (day, key) with a partial (map-side)
  step, so a key repeated in a third of all rows is collapsed inside each
  map task before the shuffle; the winner is picked with `min(struct)`,
  never by sorting a whole group.
- The seen set is first reduced to distinct keys (same partial aggregate),
  then joined with left_anti. Spark's adaptive execution broadcasts it only
  when its measured shuffle size is under the broadcast threshold, and
  splits skewed partitions of the left side otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import functions as J


def with_dedup_key(df: DataFrame, title: str = "title", url: str = "url",
                   ts: str | None = "scraped_at", key_col: str = "dedup_key",
                   day_col: str = "day") -> DataFrame:
    """Add the normalized key (and the day of `ts`, the seen set's scope)."""
    out = df.withColumn(key_col, J.dedup_key(title, url))
    if ts is not None:
        out = out.withColumn(day_col, F.to_date(F.col(ts)))
    return out


def dedup_batch(df: DataFrame, keys: Sequence[str] = ("day", "dedup_key"),
                order: Sequence[str] = ("scraped_at", "job_id"),
                count_col: str | None = "n_copies") -> DataFrame:
    """One row per key: the earliest by `order` (the first one published).

    Adding a key twice is a no-op, so later copies are dropped.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c) for c in list(order) + rest])
    aggs = [F.min(packed).alias("_w")]
    if count_col:
        aggs.append(F.count(F.lit(1)).alias(count_col))
    out = df.groupBy(*keys).agg(*aggs)
    cols = [F.col(k) for k in keys] + [F.col(f"_w.{c}").alias(c) for c in list(order) + rest]
    if count_col:
        cols.append(F.col(count_col))
    return out.select(*cols)


def seen_keys(df: DataFrame, day=None, keys: Sequence[str] = ("day", "dedup_key")) -> DataFrame:
    """Distinct members of the seen set (optionally of one day)."""
    if day is not None:
        df = df.filter(F.col("day") == F.lit(day).cast("date"))
    return df.select(*keys).distinct()


def drop_seen(df: DataFrame, seen: DataFrame,
              keys: Sequence[str] = ("day", "dedup_key")) -> DataFrame:
    """Records whose key is not in the seen set (left anti join)."""
    keys = list(keys)
    return df.join(seen.select(*keys).distinct(), on=keys, how="left_anti")


def merge_sources(*frames: DataFrame) -> DataFrame:
    """Union of collector outputs by column name; no dedup across sources."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
