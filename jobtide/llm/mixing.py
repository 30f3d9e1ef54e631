"""Mixing sources to target weights by Sainte-Lague apportionment.

1. Sizes are words. Each source's target is its weight's share of all words,
   at most REPEATS times its own size; what that cuts off is shared again by
   weight. In the end all sources below their cap are at one level per weight,
   which a running sum over the sources in the order of cap / weight gives.
2. The mix has blocks of BLOCK words. They go to the sources with the highest
   quotients target / (2 * seats + 1). All quotients above a bound that is
   known to be too high are certain, so only about as many seats as there are
   sources are ranked, whatever the number of blocks. The seats of a longer
   mix contain those of a shorter one, so each output shard gets its integer
   quota of every source.
3. A source's documents have a seeded order by a hash. Its quota is taken from
   that stream of words, whole passes first; the last pass takes the blocks
   before the quota's end.

Running sums go in two steps, over buckets of the hash and within a bucket, so
no source is ever in one task. Only functions of DataFrames are used.

Defined results: null texts have no words, take none and add none. The null
source is a source of its own, the last. Rows equal in source, doc_id and size
are numbered and taken one by one, by `mixed_documents` too. An
empty table, or one without words, gives targets of 0. Other columns are
ignored, or pass through `mixed_documents`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import numbered_copies, staged, text_of

BLOCK = 32        # words of a block
REPEATS = 3       # a source gives at most so many times its words
SHARDS = 16       # shards of the mix that get quotas
SEED = "mix-1"
MANY_SOURCES = 100_000  # up to so many rows of sources are broadcast
WORD = r"[^\x20\x09-\x0D]+"
ROW = ("name", "unnamed", "doc_id", "size")  # rows equal in these are copies


def words(column: str = "text") -> Column:
    return F.regexp_count(text_of(column), F.lit(WORD)).cast("long")


def _key(copy: Column, size: str = "size") -> Column:
    """Place in the seeded order: a hash of what names the row, copies apart."""
    return F.md5(F.concat_ws(":", F.lit(SEED), F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
                             F.col(size).cast("string"), F.when(copy > 1, copy)).cast("binary"))


def _named(docs: DataFrame) -> DataFrame:
    """Sources as a pair of non-null columns, to join and group on."""
    return docs.withColumn("name", F.coalesce(F.col("source").cast("string"), F.lit(""))) \
        .withColumn("unnamed", F.col("source").isNull())


def sized(docs: DataFrame) -> DataFrame:
    """(name, unnamed, doc_id, size, key): one narrow row per input row."""
    narrow = _named(docs.select("source", "doc_id", words().alias("size"))).select(*ROW)
    return numbered_copies(narrow).select(*ROW, _key(F.col("copy")).alias("key"))


def targets(rows: DataFrame) -> DataFrame:
    """(name, unnamed, rank, source_size, weight, target): one row per source."""
    sources = rows.groupBy("name", "unnamed").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy("unnamed", "name"))
    weighted = sources.withColumn("rank", rank) \
        .withColumn("weight", F.pmod(F.col("rank") - 1, F.lit(3)) + 1) \
        .withColumn("cap", F.col("source_size") * REPEATS)
    everything = Window.partitionBy()
    tightest = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = tightest.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    weights = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    # The level of the first source, from the tightest on, that its cap does not bind.
    level = weighted.withColumn("level", left / weights)
    fits = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(
        (F.col("cap") / F.col("weight")).alias("x"), F.col("rank"), F.col("level")))
    return level.withColumn("first", F.min(fits).over(everything)).select(
        "name", "unnamed", "rank", "source_size", "weight",
        F.least(F.col("cap").cast("double"), F.coalesce(F.col("first.level"), F.lit(0.0)) * F.col("weight"))
        .alias("target"))


def quotas(sources: DataFrame, shards: int = SHARDS, block: int = BLOCK) -> DataFrame:
    """(name, unnamed, shard, blocks): blocks of each source in each shard of the mix."""
    everything = Window.partitionBy()
    n, total = F.count(F.lit(1)).over(everything), F.sum("source_size").over(everything)
    house = F.floor(F.ceil(F.col("total") / block) * (F.col("shard") + 1) / shards)
    base = sources.withColumn("n", n).withColumn("total", total) \
        .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))) \
        .withColumn("house", house)
    scale = F.col("target") / F.greatest(F.col("total"), F.lit(1))
    certain = F.floor(F.greatest(F.col("house") - F.col("n") / 2, F.lit(0)) * scale + 0.5)
    possible = F.floor((F.col("house") + F.col("n")) * scale + 0.5)
    bounded = base.withColumn("certain", F.when(F.col("house") > F.col("n") / 2, certain).otherwise(0)) \
        .withColumn("possible", F.greatest(possible, "certain")) \
        .withColumn("open", F.col("house") - F.sum("certain").over(Window.partitionBy("shard")))
    seats = bounded.filter("possible > certain") \
        .withColumn("seat", F.explode(F.sequence(F.col("certain"), F.col("possible") - 1)))
    by_quotient = Window.partitionBy("shard").orderBy(F.desc(F.col("target") / (2 * F.col("seat") + 1)), "rank")
    won = seats.withColumn("order", F.row_number().over(by_quotient)).filter("order <= open") \
        .groupBy("rank", "shard").agg(F.count(F.lit(1)).alias("won"))
    held = bounded.join(won, ["rank", "shard"], "left") \
        .withColumn("seats", F.col("certain") + F.coalesce("won", F.lit(0)))
    earlier = F.lag("seats", 1, 0).over(Window.partitionBy("rank").orderBy("shard"))
    return held.select("name", "unnamed", "rank", "shard", (F.col("seats") - earlier).alias("blocks"))


def plan(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """Targets with what each source gives: `words` in all, `passes` whole ones and
    `rest` words of the next, and `ends`, the blocks taken when a shard is full."""
    sources = targets(rows)
    blocks = quotas(sources, block=block).groupBy("name", "unnamed").agg(
        F.sort_array(F.collect_list(F.struct("shard", "blocks"))).alias("quota"))
    given = F.least(F.aggregate("quota", F.lit(0).cast("long"), lambda s, q: s + q["blocks"]) * block,
                    F.col("source_size") * REPEATS)
    size = F.greatest("source_size", F.lit(1))
    return (sources.join(blocks, ["name", "unnamed"]).withColumn("words", given)
            .withColumn("passes", F.floor(F.col("words") / size))
            .withColumn("rest", F.col("words") % size)
            .withColumn("ends", F.transform("quota", lambda q: F.aggregate(
                F.filter("quota", lambda p: p["shard"] <= q["shard"]), F.lit(0).cast("long"),
                lambda s, p: s + p["blocks"]))).drop("quota"))


def mixed(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """Every row with its source's target and the words the mix takes of it.

    (name, unnamed, doc_id, size, key, source_size, weight, target, start,
    taken, passes, rest, shard): `start` is the place in the source's seeded stream, `shard`
    the shard of the mix that the row's first block goes to, null if none does.
    """
    return _mixed(_staged_sizes(docs), block)


def _staged_sizes(docs: DataFrame) -> DataFrame:
    return staged(sized(docs).withColumn("bucket", F.substring("key", 1, 3)), "sizes")


def _mixed(rows: DataFrame, block: int) -> DataFrame:
    sources = staged(plan(rows, block), "mix-plan")
    by_bucket = rows.groupBy("name", "unnamed", "bucket").agg(F.sum("size").alias("words_in"))
    before = Window.partitionBy("name", "unnamed").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = by_bucket.withColumn("bucket_start", F.coalesce(F.sum("words_in").over(before), F.lit(0))) \
        .drop("words_in").join(sources, ["name", "unnamed"])
    inside = Window.partitionBy("name", "unnamed", "bucket").orderBy("key", "doc_id") \
        .rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("in_bucket", F.coalesce(F.sum("size").over(inside), F.lit(0))) \
        .join(buckets, ["name", "unnamed", "bucket"]) \
        .withColumn("start", F.col("bucket_start") + F.col("in_bucket"))
    last = F.greatest(F.least(F.col("rest") - F.col("start"), F.col("size")), F.lit(0))
    taken = F.col("passes") * F.col("size") + last
    first_block = F.floor(F.col("start") / block)
    return placed.withColumn("taken", taken).select(
        "name", "unnamed", "doc_id", "size", "key", "source_size", "weight", "target", "start", "taken",
        "passes", "rest", F.when(F.col("taken") > 0, F.least(
            F.size(F.filter("ends", lambda e: e <= first_block)), F.lit(SHARDS - 1))).alias("shard"))


def mixed_documents(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """The mix as rows of `docs`, all columns: a document comes once for each pass that
    takes words of it, whole also where the last block ends inside it.

    The order's last key that is taken decides per source, so texts are not
    shuffled: the sources are broadcast if there are at most MANY_SOURCES.
    """
    sizes = _staged_sizes(docs)
    cuts = staged(_mixed(sizes, block).groupBy("name", "unnamed").agg(
        F.max("passes").alias("passes"),
        F.max(F.when((F.col("start") < F.col("rest")) & (F.col("size") > 0), F.col("key"))).alias("cut")),
        "mix-cuts").select(F.col("name").alias("__name"), F.col("unnamed").alias("__unnamed"),
                           F.col("passes").alias("__passes"), F.col("cut").alias("__cut"))
    cuts = F.broadcast(cuts) if cuts.count() <= MANY_SOURCES else cuts
    named = _named(docs.withColumn("__size", words())).select(
        *docs.columns, "__size", F.col("name").alias("__source"), F.col("unnamed").alias("__null"))
    times = F.col("__passes") + F.when(_key(F.col("__copy"), "__size") <= F.col("__cut"), 1).otherwise(0)
    return (_numbered(named, sizes).join(cuts, (F.col("__source") == F.col("__name")) & (F.col("__null") == F.col("__unnamed")))
            .filter("__size > 0").withColumn("__times", times.cast("int")).filter("__times > 0")
            .withColumn("__time", F.explode(F.sequence(F.lit(1), "__times"))).select(*docs.columns))


def _numbered(named: DataFrame, sizes: DataFrame) -> DataFrame:
    """The rows with `__copy`, the number that `sized` gives a repeated row.

    The narrow `sizes` tell whether any row repeats. Only rows that repeat are
    shuffled. They are numbered by a hash of the whole row, within their input
    split, after the counts of what comes before.
    """
    key = ["__source", "__null", "doc_id", "__size"]
    repeats = staged(sizes.groupBy(*(F.col(c).alias(k) for c, k in zip(ROW, key)))
                     .agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "mix-repeats")
    if repeats.isEmpty():
        return named.withColumn("__copy", F.lit(1).cast("long"))
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in key]
    together = same[0] & same[1] & same[2] & same[3]
    once = named.alias("l").join(repeats.alias("r"), together, "left_anti").withColumn("__copy", F.lit(1).cast("long"))
    again = named.alias("l").join(repeats.alias("r"), together, "left_semi") \
        .withColumn("__row", F.xxhash64(*named.columns)).withColumn("__split", F.spark_partition_id())
    again = staged(again, "mix-copies")
    counts = again.groupBy(*key, "__row", "__split").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy(*key).orderBy("__row", "__split").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.withColumn("__before", F.coalesce(F.sum("n").over(earlier), F.lit(0).cast("long"))).drop("n")
    inside = Window.partitionBy(*key, "__row", "__split").orderBy("__row")
    placed = again.withColumn("__in", F.row_number().over(inside))
    on = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in [*key, "__row", "__split"]]
    both = placed.alias("a").join(before.alias("b"), on)
    return once.unionByName(both.select(*(F.col(f"a.{c}") for c in named.columns),
                                        (F.col("__before") + F.col("__in")).alias("__copy")))
