"""Sharding by fixed virtual slots: records hash into SLOTS slots, slots map to shards.

The hash of a record never changes; what changes is a small versioned table
slot -> shard. `rebalanced` edits it: each shard keeps its largest slots up to
an equal share of the bytes, the rest move, largest first, to the shard with
the fewest bytes. So shards are equal in bytes up to the last slot moved, and
a shard that is added receives only what the others have too much of.

Everything is DataFrame functions. Rows reduce to narrow records first; texts
are never shuffled. Repeated records are counted, partial counts first, and get
a number each, so that copies spread over the slots; a record's virtual slot
depends on the record and its number alone, not on the input's splits.

Defined results: a null text has the size 1 and the checksum of no bytes.
Null doc_ids are hashed like any value. Repeated rows are placed one by one.
An empty table gives an empty result and an unedited map. Columns other than
doc_id and text are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import numbered_copies, staged, text_of

SLOTS = 4096
MAP = "version int, shards int, slot int, shard int"


def records(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """(doc_id, size, text_crc32, vslot, copy): one narrow row per input row."""
    narrow = docs.select("doc_id", (F.octet_length(text_of()).cast("long") + 1).alias("size"),
                         F.crc32(text_of().cast("binary")).alias("text_crc32"))
    repeat = F.when(F.col("copy") > 1, F.col("copy"))
    slot = F.pmod(F.xxhash64("doc_id", "size", "text_crc32", repeat), F.lit(slots)).cast("int")
    return numbered_copies(narrow).select("doc_id", "size", "text_crc32", slot.alias("vslot"), "copy")


def slot_totals(rows: DataFrame) -> DataFrame:
    """(slot, bytes, rows) of the slots in use; at most SLOTS rows."""
    return rows.groupBy(F.col("vslot").alias("slot")).agg(F.sum("size").alias("bytes"),
                                                          F.count(F.lit(1)).alias("rows"))


def first_map(spark: SparkSession, shards: int, slots: int = SLOTS) -> DataFrame:
    """Version 0: slots dealt to the shards in turn."""
    slot = F.col("id").cast("int")
    return spark.range(slots).select(F.lit(0).alias("version"), F.lit(shards).alias("shards"),
                                     slot.alias("slot"), F.pmod(slot, F.lit(shards)).alias("shard"))


def rebalanced(current: DataFrame, totals: DataFrame, shards: int) -> DataFrame:
    """The next version of the map, for `shards` shards of near-equal bytes.

    The map has a fixed number of slots, so the running choice of the emptiest
    shard is one `aggregate` over at most that many array entries.
    """
    sized = current.join(totals.select("slot", "bytes"), "slot", "left") \
        .withColumn("bytes", F.coalesce("bytes", F.lit(0).cast("long")))
    equal = F.ceil(F.sum("bytes").over(Window.partitionBy()) / shards)
    largest_first = Window.partitionBy("shard").orderBy(F.desc("bytes"), "slot")
    stays = (F.col("shard") < shards) & (
        F.sum("bytes").over(largest_first.rowsBetween(Window.unboundedPreceding, 0)) <= F.col("equal"))
    marked = sized.withColumn("equal", equal).withColumn("stays", stays)
    moving = F.sort_array(F.collect_list(F.when(~F.col("stays"), F.struct(
        (-F.col("bytes")).alias("less"), "slot"))))
    loads = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda k: F.aggregate(
        F.collect_list(F.when(F.col("stays"), F.struct("shard", "bytes"))), F.lit(0).cast("long"),
        lambda total, x: total + F.when(x["shard"] == k, x["bytes"]).otherwise(0)))
    state = marked.agg(F.max("version").alias("version"), moving.alias("moving"), loads.alias("loads"))

    def place(done, slot):
        to = F.array_position(done["loads"], F.array_min(done["loads"])).cast("int") - 1
        return F.struct(
            F.transform(done["loads"], lambda load, k: load - F.when(k == to, slot["less"]).otherwise(0))
            .alias("loads"),
            F.concat(done["placed"], F.array(to)).alias("placed"))

    start = F.struct(F.col("loads").alias("loads"), F.expr("array_repeat(0, 0)").alias("placed"))
    placed = state.select("moving", F.aggregate("moving", start, place)["placed"].alias("placed"))
    moved = placed.select(F.explode(F.arrays_zip("moving", "placed")).alias("m")) \
        .select(F.col("m.moving.slot").alias("slot"), F.col("m.placed").alias("to"))
    return current.join(moved, "slot", "left").select(
        (F.col("version") + 1).alias("version"), F.lit(shards).alias("shards"), "slot",
        F.coalesce("to", "shard").alias("shard"))


def placed(rows: DataFrame, totals: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Records with their shard and their gapless place in it.

    A place is the rows of the shard's earlier slots plus the rank in the slot.
    The map is broadcast: it has as many rows as there are slots.
    """
    earlier = Window.partitionBy("shard").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.join(slot_map, "slot").select(
        F.col("slot").alias("vslot"), "shard", "version",
        F.coalesce(F.sum("rows").over(earlier), F.lit(0).cast("long")).alias("before"))
    in_slot = Window.partitionBy("vslot").orderBy("doc_id", "size", "text_crc32", "copy")
    return (rows.withColumn("rank", F.row_number().over(in_slot) - 1)
            .join(F.broadcast(starts), "vslot")
            .withColumn("place", F.col("before") + F.col("rank")))


def sharded(docs: DataFrame, shards: int = 16, slots: int = SLOTS,
            slot_map: DataFrame | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard, vslot, map_version) per row.

    `slot_map`: the stored map to edit; without one, version 0. The law is
    `bytes`; `slot` is the place in the shard, `vslot` the virtual slot.
    """
    rows = staged(records(docs, slots), "records")
    totals = staged(slot_totals(rows), "slot-totals")
    current = first_map(docs.sparkSession, shards, slots) if slot_map is None else slot_map
    edited = staged(rebalanced(current, totals, shards), "slot-map")
    return placed(rows, totals, edited).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        F.col("place").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        "vslot", F.col("version").alias("map_version"))
