"""Document fingerprints by a randomised edit embedding, and the near copies they find.

1. A shared random walk reads every text: at step j a pointer stands on a
   character c and moves on if bit (c, j) of a fixed random table is set. The
   text that the pointer spells, step by step, is the embedding. Walks of two
   texts that part at an edit meet again with the chance of a random walk, so a
   small edit distance becomes a small Hamming distance.
2. A fingerprint samples the embedding in up to BLOCKS stretches of 2^level
   steps, one place of each, as 4 bits of a hash of (character, step). Places
   are nested: those of a level are every second one, by a coin, of the level
   below, so texts of different levels compare at the coarser one. The likeness
   of two fingerprints is the share of equal samples, of the longer one's.
3. Banding: two texts are candidates from a likeness of LIKE on. Then at most
   (1 - LIKE) of the samples differ, so of one band more than that, drawn by a
   fixed shuffle of the samples, one agrees in full: no pair is missed. The
   number of bands follows the size, in steps; a text is listed under its own
   size and, if a partner could be a step larger, under that.
4. The members of a band's list are compared inside tasks, in blocks; only links
   that join components leave them. Verification walks both whole texts: the
   characters that both walks spell at the same steps are a common subsequence,
   which gives a script of edits. Links whose script keeps SHARE of the longer
   text stay. A failed link is left out and its lists are compared again, until
   none fails, so every link that passes lies inside one component.

The edited text of a document has its last third replaced by the start of the
next document, by falling doc_id; equal doc_ids are ordered by a hash of the
text, null ones come last, and the first follows the last. Ranges of that order
are sorted, and each hands its first and last text on.

Defined results: a null text is empty. Empty texts are alike, and unlike all
others. A single row is followed by itself. Repeated rows follow one another;
they are interchangeable. `near_id` is the least doc_id of all rows whose texts
are equal or linked, null if none has one. An empty table gives an empty result.
Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from array import array
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import MIX_A, mixed, staged, text_of
from .components import connected_components

BLOCKS = 128           # most samples of a fingerprint
LIKE = 0.9             # least likeness of fingerprints that are verified
SHARE = 0.8            # least share of the longer text that a link's script keeps
CLASSES, PERIOD = 256, 1 << 14  # of the table of bits: classes of characters, steps
STEP = 1.2             # ratio of sizes that share a number of bands; over 1 / LIKE
MEMBERS = 2048         # members of a list compared with as many others in one task
FEW_TEXTS = 250_000    # up to so many texts to verify are named by a broadcast
ABSENT = 255
SEED = np.uint64(0x5EED11)


class Walk(NamedTuple):
    """The characters of a text and the step at which the pointer leaves each."""

    codes: np.ndarray
    ends: np.ndarray


class Fingerprint(NamedTuple):
    level: int
    samples: np.ndarray  # 4 bits each

    def __str__(self) -> str:
        return f"{self.level:x}:" + self.samples.astype(np.uint8).tobytes().hex()[1::2]


def parsed(text: str) -> Fingerprint:
    level, samples = text.split(":")
    return Fingerprint(int(level, 16), np.frombuffer(bytes.fromhex("".join("0" + x for x in samples)), np.uint8))


@lru_cache(1)
def waits() -> list[bytes]:
    """Per class and step: the steps until the pointer moves on, from a fixed table of bits that
    is read in a circle."""
    steps_, out = np.arange(PERIOD), []
    for c in range(CLASSES):
        cells = np.arange(c * PERIOD, (c + 1) * PERIOD, dtype=np.uint64) * MIX_A + SEED
        ones = np.flatnonzero(mixed(cells) >> np.uint64(63))
        following = np.append(ones, ones[0] + PERIOD)[np.searchsorted(ones, steps_)]
        out.append(np.minimum(following - steps_ + 1, 255).astype(np.uint8).tobytes())
    return out


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def steps(codes: np.ndarray, start: int = 0) -> np.ndarray:
    """Where the walk leaves each character, from step `start` on."""
    table, mask = waits(), PERIOD - 1
    j, ends = start, array("q")
    for c in ((codes + (codes >> 8) * 101) & 255).astype(np.uint8).tobytes():
        j += table[c][j & mask]
        ends.append(j)
    return np.frombuffer(ends, np.int64)


def walk(text: str) -> Walk:
    codes = code_points(text)
    return Walk(codes, steps(codes))


@lru_cache(64)
def chosen(level: int) -> np.ndarray:
    """Which of the two blocks below each block of this level takes its place."""
    cells = np.arange(BLOCKS, dtype=np.uint64) * MIX_A + SEED * np.uint64(level + 2)
    return 2 * np.arange(BLOCKS) + (mixed(cells) >> np.uint64(63)).astype(np.int64)


@lru_cache(64)
def sampled_steps(level: int) -> np.ndarray:
    """The sampled step of each block. Beyond BLOCKS blocks the coins repeat."""
    places = np.arange(BLOCKS)
    for k in range(level, 0, -1):
        base, rest = places // BLOCKS, places % BLOCKS
        places = 2 * BLOCKS * base + chosen(k)[rest]
    return places


def fingerprint(w: Walk) -> Fingerprint:
    last = int(w.ends[-1]) if len(w.ends) else 0
    level = max(0, math.ceil(last / BLOCKS) - 1).bit_length()
    at = sampled_steps(level)
    at = at[:np.searchsorted(at, last)]
    codes = w.codes[np.searchsorted(w.ends, at, side="right")].astype(np.uint64)
    samples = mixed(codes * MIX_A + at.astype(np.uint64) + SEED) >> np.uint64(60)
    return Fingerprint(level, samples.astype(np.uint8))


def coarser(f: Fingerprint) -> Fingerprint:
    """The samples at the next level."""
    at = chosen(f.level + 1)
    return Fingerprint(f.level + 1, f.samples[at[:np.searchsorted(at, len(f.samples))]])


def likeness(a: Fingerprint, b: Fingerprint) -> float:
    while a.level < b.level:
        a = coarser(a)
    while b.level < a.level:
        b = coarser(b)
    size, most = sorted((len(a.samples), len(b.samples)))
    return float((a.samples[:size] == b.samples[:size]).sum() / most) if most else 1.0


def kept_share(a: Walk, b: Walk) -> float:
    """1 less the edits of the walks' script over the longer text's length: never above the
    edit similarity.

    Characters that both walks meet at the same step are kept; between two kept
    ones the longer side's characters are edits.
    """
    most = max(len(a.codes), len(b.codes))
    if not most:
        return 1.0
    starts = [np.concatenate(([0], w.ends))[:len(w.ends)] for w in (a, b)]
    _, i, j = np.intersect1d(*starts, assume_unique=True, return_indices=True)
    same = a.codes[i] == b.codes[j]
    i = np.concatenate(([-1], i[same], [len(a.codes)]))
    j = np.concatenate(([-1], j[same], [len(b.codes)]))
    return 1.0 - float((np.maximum(np.diff(i), np.diff(j)) - 1).sum()) / most


# ------------------------------------------------------------ fingerprints

class Document(NamedTuple):
    doc_id: int | None
    text: str
    walk: Walk
    print: Fingerprint

    @classmethod
    def of(cls, doc_id, text):
        w = walk(text)
        return cls(doc_id, text, w, fingerprint(w))


def described(doc: Document, following: Document) -> tuple:
    """The row of a document, from it and the next one."""
    n = len(doc.text)
    cut = n - n // 3
    tail = following.walk.codes[:n // 3]
    start = int(doc.walk.ends[cut - 1]) if cut else 0
    edited = Walk(np.concatenate((doc.walk.codes[:cut], tail)),
                  np.concatenate((doc.walk.ends[:cut], steps(tail, start))))
    digest = hashlib.sha256((doc.text[:cut] + following.text[:n // 3]).encode("utf-8", "surrogatepass")).hexdigest()
    printed = fingerprint(edited)
    return (doc.doc_id, n, digest, str(doc.print), str(printed), likeness(doc.print, printed),
            likeness(doc.print, following.print), hashlib.md5(doc.text.encode("utf-8", "surrogatepass")).digest())


COLUMNS = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double, text_md5 binary")
EDGE = ", part int, first_text binary, last_text binary"
KINDS = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "double": pa.float64(), "binary": pa.binary()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, kinds = zip(*(x.split() for x in schema.split(", ")))
    return pa.RecordBatch.from_arrays([pa.array(c, KINDS[k]) for c, k in zip(zip(*rows), kinds)], names=list(names))


def _packed(docs: DataFrame) -> DataFrame:
    """(doc_id, tie, packed): texts compressed, as they are shuffled."""
    def run(batches):
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            packed = pa.array([pack(x) for x in batch.column(2).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), packed], names=["doc_id", "tie", "packed"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_of()).alias("tie"),
                       text_of().cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, tie long, packed binary")


def _unpacked(packed: bytes) -> str:
    return zstandard.ZstdDecompressor().decompress(packed).decode("utf-8", "replace")


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, text_md5) per row."""
    def run(batches):
        first, before, part = None, None, None
        for batch in batches:
            out = []
            for part, doc_id, packed in zip(*(c.to_pylist() for c in batch.columns)):
                doc = Document.of(doc_id, _unpacked(packed))
                if before is None:
                    first = packed
                else:
                    out.append((*described(before, doc), None, None, None))
                before, last = doc, packed
            if out:
                yield _batch(out, COLUMNS + EDGE)
        if before is not None:
            edge = [None] * len(COLUMNS.split(", "))
            edge[0] = before.doc_id
            yield _batch([(*edge, part, first, last)], COLUMNS + EDGE)

    def across(batches):
        for batch in batches:
            out = [described(Document.of(doc_id, _unpacked(last)), Document.of(None, _unpacked(first)))
                   for doc_id, last, first in zip(*(c.to_pylist() for c in batch.columns))]
            if out:
                yield _batch(out, COLUMNS)

    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("tie")]
    dealt = _packed(docs).repartitionByRange(ranges, *order, F.monotonically_increasing_id()) \
        .sortWithinPartitions(*order)
    done = staged(dealt.select(F.spark_partition_id().alias("part"), "doc_id", "packed")
                  .mapInArrow(run, COLUMNS + EDGE), "fingerprints")
    edges = done.filter("part IS NOT NULL").select("part", "doc_id", "first_text", "last_text")
    every = Window.orderBy("part")  # a row per range
    following = edges.select("part").withColumn("next", F.coalesce(
        F.lead("part").over(every), F.min("part").over(Window.partitionBy())))
    pairs = edges.join(following, "part").select("doc_id", "last_text", "next").join(
        edges.select(F.col("part").alias("next"), "first_text"), "next").select("doc_id", "last_text", "first_text")
    names = [x.split()[0] for x in COLUMNS.split(", ")]
    return done.filter("part IS NULL").select(*names).unionByName(pairs.mapInArrow(across, COLUMNS))


# ------------------------------------------------------------ near copies

def size_step(size: float) -> int:
    """Sizes in (STEP^(k-1), STEP^k] are of step k."""
    return max(0, math.ceil(round(math.log(max(size, 1)) / math.log(STEP), 9)))


@lru_cache(256)
def bands_of(step: int) -> np.ndarray:
    """The band of each sample, for pairs whose larger size is of this step: a shuffle of the
    bands for each run of as many samples, so that no band is empty."""
    most = min(BLOCKS, int(STEP ** step + 1e-6))
    count = int((1 - LIKE) * most + 1e-9) + 1
    coins = mixed(np.arange(-(-BLOCKS // count) * count, dtype=np.uint64) * MIX_A + SEED + np.uint64(7 * step))
    return np.argsort(coins.reshape(-1, count), axis=1).ravel()[:BLOCKS]


def band_keys(f: Fingerprint) -> set[tuple[int, int]]:
    """(level, key) of the bands under which a fingerprint is listed."""
    keys = set()
    # A partner of the next level has more than half of BLOCKS samples there.
    for view, least in ((f, 1), (coarser(f), BLOCKS // 2)) if len(f.samples) else ():
        size = len(view.samples)
        low, high = max(size, least), min(BLOCKS, int(size / LIKE + 1e-9))
        for step in range(size_step(low), size_step(high) + 1) if low <= high else ():
            band = bands_of(step)[:size]
            for k in range(int(band.max()) + 1):
                keys.add((view.level, _key(view.level, step, k, view.samples[band == k].tobytes())))
    return keys


def _key(*parts) -> int:
    return int.from_bytes(hashlib.blake2b(repr(parts).encode(), digest_size=8).digest(), "little", signed=True)


def links_in_list(level: int, prints: list[Fingerprint], members: list[int], avoid: list[set]) -> list[tuple[int, int]]:
    """Pairs of LIKE and more, as a forest with the components of all such pairs but those to avoid."""
    own = np.array([p.level == level for p in prints])
    views = [p if p.level == level else coarser(p) for p in prints]
    sizes = np.array([len(v.samples) for v in views])
    table = np.full((len(views), BLOCKS), ABSENT, np.uint8)
    for k, v in enumerate(views):
        table[k, :len(v.samples)] = v.samples
    component, found = np.arange(len(views)), []
    for q in np.argsort(members, kind="stable").tolist():
        others = np.flatnonzero((component != component[q]) & (own | own[q]))
        if not len(others):
            continue
        equal = ((table[others] == table[q]) & (table[others] != ABSENT)).sum(axis=1)
        near = others[equal >= LIKE * np.maximum(sizes[others], sizes[q]) - 1e-9]
        for x in near.tolist():
            if members[x] not in avoid[q] and component[x] != component[q]:
                component[component == component[x]] = component[q]
                found.append((members[q], members[x]))
    return found


def _lists(classes: DataFrame) -> DataFrame:
    """(key, level, member): the lists that hold more than one class."""
    def run(batches):
        for batch in batches:
            out = [(key, level, member) for member, text in zip(*(c.to_pylist() for c in batch.columns))
                   for level, key in band_keys(parsed(text))]
            if out:
                yield _batch(out, "key long, level int, member long")

    postings = staged(classes.select("member", "fingerprint").mapInArrow(run, "key long, level int, member long"), "bands")
    shared = staged(postings.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "shared-bands")
    return postings.join(shared, "key")


def _links(lists: DataFrame, classes: DataFrame, failed: DataFrame) -> DataFrame:
    """(a, b): links that join the components of each list, without the failed ones."""
    blocks = F.ceil(F.col("n") / MEMBERS).cast("int")
    own = F.pmod(F.xxhash64("member"), F.col("blocks")).cast("int")
    both = failed.unionByName(failed.select(F.col("b").alias("a"), F.col("a").alias("b")))
    avoid = both.groupBy(F.col("a").alias("member")).agg(F.collect_set("b").alias("avoid"))
    rows = (lists.join(classes.select("member", "fingerprint"), "member").join(avoid, "member", "left")
            .withColumn("blocks", blocks).withColumn("own", own)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "level", "member",
                    "fingerprint", "avoid"))

    def run(batches):
        at, level, group = None, None, {}

        def linked():
            if len(group) > 1:
                members = list(group)
                pairs = links_in_list(level, [parsed(p) for p, _ in group.values()], members,
                                      [set(a or ()) for _, a in group.values()])
                if pairs:
                    yield _batch([(min(p), max(p)) for p in pairs], "a long, b long")

        for batch in batches:
            for key, i, j, own_level, member, printed, avoided in zip(*(c.to_pylist() for c in batch.columns)):
                if (key, i, j) != at:
                    yield from linked()
                    at, level, group = (key, i, j), own_level, {}
                group[member] = (printed, avoided)
        yield from linked()

    return rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "member") \
        .mapInArrow(run, "a long, b long").distinct()


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b, ok) of each pair, from both whole texts."""
    def run(batches):
        open_, left = None, None
        for batch in batches:
            out = []
            for a, b, x, y in zip(*(c.to_pylist() for c in batch.columns)):
                if a != open_:
                    open_, left = a, walk(_unpacked(x))
                out.append((a, b, kept_share(left, walk(_unpacked(y))) >= SHARE))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["a", "b", "ok"])

    left = texts.select(F.col("member").alias("a"), F.col("packed").alias("x"))
    right = texts.select(F.col("member").alias("b"), F.col("packed").alias("y"))
    return pairs.join(right, "b").join(left, "a").select("a", "b", "x", "y").mapInArrow(run, "a long, b long, ok boolean")


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(member, packed): one compressed text per wanted class (member, text_md5)."""
    def run(batches):
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([pack(x) for x in batch.column(1).to_pylist()], pa.binary())],
                names=["member", "packed"])

    wanted = F.broadcast(wanted) if wanted.count() <= FEW_TEXTS else wanted
    keyed = docs.select(text_of().cast("binary").alias("text")).withColumn("text_md5", F.unhex(F.md5("text")))
    found = keyed.join(wanted, "text_md5").select("member", "text").mapInArrow(run, "member long, packed binary")
    return staged(found.groupBy("member").agg(F.min("packed").alias("packed")), "near-texts")


def near_links(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(a, b): verified links between classes (member, text_md5, fingerprint) that give the
    components of all links."""
    spark = docs.sparkSession
    lists = staged(_lists(classes), "lists")
    good = failed = spark.createDataFrame([], "a long, b long")
    groups, texts = lists, None
    while True:
        pairs = staged(_links(groups, classes, failed).join(good, ["a", "b"], "left_anti"), "links")
        if pairs.isEmpty():
            return good
        ends = pairs.select(F.col("a").alias("member")).union(pairs.select("b")).distinct()
        texts = _texts(docs, staged(ends.join(classes.select("member", "text_md5"), "member"), "ends"))
        checked = staged(_verified(pairs, texts), "checked")
        good = good.unionByName(checked.filter("ok").drop("ok"))
        bad = checked.filter("NOT ok").drop("ok")
        if bad.isEmpty():
            return good
        failed = failed.unionByName(bad)
        keys = bad.join(lists.select(F.col("member").alias("a"), "key"), "a") \
            .join(lists.select(F.col("member").alias("b"), "key"), ["b", "key"]).select("key").distinct()
        groups = staged(lists.join(keys, "key"), "lists-again")


def near_copies(docs: DataFrame) -> DataFrame:
    """The rows of `fingerprints` with `near_id`: the least doc_id among equal and linked texts."""
    rows = staged(fingerprints(docs), "document-prints")
    classes = staged(rows.groupBy("text_md5").agg(F.min("doc_id").alias("first_id"), F.min("fingerprint").alias("fingerprint"))
                     .withColumn("member", F.monotonically_increasing_id()), "classes")
    roots = connected_components(near_links(docs, classes.filter("fingerprint != '0:'")), "a", "b")
    # Both sides of each join are plain shuffles, which adaptive execution can split at a hot key.
    labelled = staged(classes.select("text_md5", "first_id", "member").join(
        roots.withColumnRenamed("node", "member"), "member", "left").withColumn("root", F.coalesce("root", "member")), "labelled")
    smallest = staged(labelled.groupBy("root").agg(F.min("first_id").alias("near_id")), "smallest")
    named = staged(labelled.join(smallest, "root").select("text_md5", "near_id"), "names")
    return rows.join(named, "text_md5").select(*rows.columns, "near_id")
