"""Connected components of an edge table, by alternating large and small stars.

Every round is two narrow aggregates and two joins; hubs are summed before the
shuffle and split by the adaptive skew join. Each round is written to shared
storage, so nothing is collected and a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")),
                    F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
    return tuple(row)


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): each node of an edge with the smallest node it reaches.

    Loops and repeated edges are fine, null ends are ignored; nodes without an
    edge to another node are absent. An empty table gives an empty table.
    """
    low, high = F.least(a, b), F.greatest(a, b)
    pairs = edges.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    current = staged(pairs.select(high.alias("u"), low.alias("v")).distinct(), "edges")
    mark = _mark(current)
    while mark[0]:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
        large = (both.join(lowest, "u").filter(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        nearest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(nearest, "u")
                 .select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
                         F.col("m").alias("v")).distinct())
        following = staged(small, "edges")
        before, mark = mark, _mark(following)
        current = following
        if mark == before:
            break
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
