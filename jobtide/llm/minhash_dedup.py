"""MinHash near-dedup: bottom-k sketches of one hash function, exact links, components.

1. Every document becomes its set of word shingles (64-bit hashes, all of the
   text); documents of one set form one class, so copies are never compared.
   A class keeps a sketch: the `SKETCH` smallest hashes of its set.
2. Inverted lists over retained values generate overlaps. Two sets of the
   wanted similarity share at least `needed` retained values (a bound that
   fails with a chance under 1e-9 a pair for large sets and never for sets
   within the sketch). So each class is listed only under its
   `size - needed + 1` rarest retained values, and not at all if fewer than
   `needed` of them occur in another class.
3. Members of a list meet at the head of the list, its class with the most
   widespread values: rows grow with the postings, not with their square.
   A head's family is compared in blocks inside a task, where the overlap of
   sketches, the union-sketch estimate and at last the exact Jaccard of the
   full sets decide; only links that join two components leave the task.
4. Components of the links; the smallest doc_id of a component is its id.

The small sides of joins (counts, heads, names) are written first: both sides
of such a join are then plain shuffles, which adaptive execution can split
where a key is hot.

Defined results: null or blank texts have an empty set and link with nothing;
their component is their own doc_id. Repeated rows are copies. A null doc_id
takes part, but a component's id is null only if all its doc_ids are. Other
columns are ignored by `near_duplicates` and pass through `keep_first`.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (WordHashes, binary_slices, list_array, shingle_set, staged, text_of)
from .components import connected_components

SKETCH = 48     # retained values of a set
MISS = 1e-9     # accepted chance that a link's sketches share too few values
BLOCK = 1024    # members of a family compared with as many others in one task,
BLOCK_SHINGLES = 1 << 20  # or fewer, of about so many shingles (8 MB of hashes)

SKETCHED = ("doc_id long, text_md5 binary, n_shingles long, set_id binary, sketch array<long>")


def set_id(shingles: np.ndarray) -> bytes | None:
    """Twelve bytes that stand for the whole set."""
    return hashlib.blake2b(shingles.tobytes(), digest_size=12).digest() if len(shingles) else None


def needed_large(percent: int) -> int:
    """Retained values that two sets of this similarity share but for a chance of MISS:
    each of the union's SKETCH smallest values is common with the chance of the similarity."""
    p, tail = percent / 100, 0.0
    for shared in range(SKETCH + 1):
        tail += math.comb(SKETCH, shared) * p ** shared * (1 - p) ** (SKETCH - shared)
        if tail > MISS:
            return shared
    return SKETCH


def needed_percent(percent: int) -> int:
    """The same in percent of a set that its sketch holds in full. This one never fails:
    a partner has at most 100/percent times the values, so few of them are its own."""
    return int(200 - 10_000 / percent)


def sketched(docs: DataFrame, words: int) -> DataFrame:
    """One narrow row per document: its set's size, id and bottom-k sketch."""
    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            sizes, ids, sketches = [], [], []
            for text in binary_slices(batch.column(2)):
                shingles = shingle_set(hashes.of(text.lower().split()), words)
                sizes.append(len(shingles))
                ids.append(set_id(shingles))
                sketches.append(shingles[:SKETCH].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary()),
                 list_array(pa, sketches, pa.int64())],
                names=["doc_id", "text_md5", "n_shingles", "set_id", "sketch"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.unhex(F.md5(text_of().cast("binary"))).alias("text_md5"),
                       text_of().cast("binary").alias("text"))
    return rows.mapInArrow(run, SKETCHED)


def _listed(classes: DataFrame, percent: int) -> DataFrame:
    """(value, set_id, weight, n_shingles): each class under its rarest retained values."""
    postings = classes.select("set_id", "n_shingles", F.explode("sketch").alias("value"))
    shared = staged(postings.groupBy("value").agg(F.count(F.lit(1)).alias("df")).filter("df > 1"), "shared")
    size = F.size("values")
    needed = (F.when(F.col("n_shingles") <= SKETCH,
                     F.ceil(F.col("n_shingles") * needed_percent(percent) / 100))
              .otherwise(needed_large(percent))).cast("int")
    per_class = (postings.join(shared, "value").groupBy("set_id", "n_shingles")
                 .agg(F.sort_array(F.collect_list(F.struct("df", "value"))).alias("values"),
                      F.sum("df").alias("weight"))
                 .filter(size >= needed))
    return per_class.select("set_id", "weight", "n_shingles",
                            F.explode(F.slice("values", F.lit(1), size - needed + 1)).alias("v")) \
        .select(F.col("v.value").alias("value"), "set_id", "weight", "n_shingles")


def _families(lists: DataFrame) -> DataFrame:
    """(head, set_id, weight, n_shingles), each once: all classes listed with a head, itself included."""
    heads = staged(lists.groupBy("value").agg(F.max(F.struct("weight", "set_id")).alias("head"),
                                              F.count(F.lit(1)).alias("n")).filter("n > 1")
                   .select("value", F.col("head.set_id").alias("head")), "heads")
    return lists.join(heads, "value").select("head", "set_id", "weight", "n_shingles").distinct()


def _blocks(families: DataFrame) -> DataFrame:
    """A family in blocks of about BLOCK members and BLOCK_SHINGLES shingles; each pair of
    blocks is one group."""
    counts = staged(families.groupBy("head").agg(F.ceil(F.greatest(
        F.count(F.lit(1)) / BLOCK, F.sum("n_shingles") / BLOCK_SHINGLES)).cast("int").alias("blocks")), "family-sizes")
    own = F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int")
    return (families.join(counts, "head").withColumn("own", own)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("head", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                    "set_id", "weight"))


class Joined:
    """Union-find over positions."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        self.parent[max(x, y)] = min(x, y)
        return x != y


def _inverted(sets: list[np.ndarray]):
    """Local ids of each set's values and, per value, the members that hold it."""
    flat = np.concatenate(sets)
    owners = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, local = np.unique(flat, return_inverse=True)
    order = np.argsort(local, kind="stable")
    starts = np.zeros(local.max() + 2, np.int64)
    np.cumsum(np.bincount(local), out=starts[1:])
    ends = np.cumsum([len(s) for s in sets])
    return [local[e - len(s):e] for s, e in zip(sets, ends)], owners[order], starts


def _overlaps(values: np.ndarray, holders: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    parts = [holders[starts[v]:starts[v + 1]] for v in values]
    return np.bincount(np.concatenate(parts), minlength=n)


def union_estimate(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the bottom-k sketch of the union that both sketches hold."""
    union = np.union1d(a, b)[:SKETCH]
    both = np.intersect1d(a, b, assume_unique=True)
    return np.isin(union, both, assume_unique=True).sum() / max(1, len(union))


def links_in_group(sets: list[np.ndarray], weights: list[int], percent: int) -> list[tuple[int, int]]:
    """Exact links of a group, as a forest with the same components."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    sketches = [s[:SKETCH] for s in sets]
    needed = np.where(sizes <= SKETCH, -(-sizes * needed_percent(percent) // 100), needed_large(percent))
    joined, found = Joined(n), []
    order = sorted(range(n), key=lambda x: -weights[x])
    local, holders, starts = _inverted(sketches)
    full = None
    passed = np.zeros(n, bool)
    for q in order:
        passed[q] = True
        shared = _overlaps(local[q], holders, starts, n)
        near = ((shared >= np.minimum(needed, needed[q])) & ~passed
                & (100 * np.minimum(sizes, sizes[q]) >= percent * np.maximum(sizes, sizes[q])))
        mine = joined.root(q)
        others = [x for x in np.flatnonzero(near).tolist() if joined.root(x) != mine]
        if not others:
            continue
        if len(others) <= 8:
            least = needed_large(percent) / SKETCH  # of the estimate, failing under MISS
            others = [x for x in others if union_estimate(sketches[q], sketches[x]) >= least]
            exact = {x: len(np.intersect1d(sets[q], sets[x], assume_unique=True)) for x in others}
        else:
            full = full or _inverted(sets)
            exact = _overlaps(full[0][q], full[1], full[2], n)
        for x in others:
            both = int(exact[x])
            if 100 * both >= percent * (int(sizes[q]) + int(sizes[x]) - both) and joined.join(q, x):
                found.append((q, x))
    return found


def _verified(groups: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (a, b) out of the sorted groups (head, i, j) of members with texts."""
    def linked(group: dict, hashes: WordHashes):
        ids = list(group)
        sets = [shingle_set(hashes.of(text.lower().split()), words) for text, _ in group.values()]
        pairs = links_in_group(sets, [w for _, w in group.values()], percent) if len(ids) > 1 else []
        return [ids[x] for x, _ in pairs], [ids[y] for _, y in pairs]

    def run(batches):
        hashes, key, group = WordHashes(), None, {}

        def batch_of(pair):
            return pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in pair], names=["a", "b"])

        for batch in batches:
            for head, i, j, member, weight, text in zip(*(c.to_pylist() for c in batch.columns)):
                if (head, i, j) != key:
                    if len(group) > 1:
                        yield batch_of(linked(group, hashes))
                    key, group = (head, i, j), {}
                group[member] = (text, weight)
        if len(group) > 1:
            yield batch_of(linked(group, hashes))

    return groups.mapInArrow(run, "a binary, b binary")


def near_links(docs: DataFrame, rows: DataFrame, words: int, percent: int) -> DataFrame:
    """(a, b): verified links between set ids that give the components of all links."""
    best = F.min(F.struct("doc_id", "text_md5", "n_shingles", "sketch")).alias("first")
    classes = rows.filter("n_shingles > 0").groupBy("set_id").agg(best).select("set_id", "first.*")
    classes = staged(classes, "classes")
    families = staged(_families(staged(_listed(classes, percent), "lists")), "families")
    members = families.select("set_id").distinct()
    chosen = classes.join(members, "set_id", "left_semi").select("set_id", "doc_id", "text_md5")
    keyed = docs.select(F.col("doc_id").cast("long").alias("id"), text_of().cast("binary").alias("text")) \
        .withColumn("md5", F.unhex(F.md5("text")))
    texts = keyed.join(chosen, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("md5") == F.col("text_md5"))) \
        .select("set_id", "text")
    groups = (_blocks(families).join(texts, "set_id")
              .select("head", "i", "j", "set_id", "weight", "text")
              .repartition("head", "i", "j").sortWithinPartitions("head", "i", "j"))
    return _verified(groups, words, percent)


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, text_md5, n_shingles, set_id, component_id) for every row of `docs`.

    `words`: words of a shingle; `percent`: least Jaccard similarity of a link.
    The bounds of candidate search hold for `percent` of 80 and more.
    """
    rows = staged(sketched(docs, words), "sketches")
    roots = connected_components(near_links(docs, rows, words, percent), "a", "b")
    labelled = staged(rows.groupBy("set_id").agg(F.min("doc_id").alias("first_id"))
                      .filter("set_id IS NOT NULL")
                      .join(roots.withColumnRenamed("node", "set_id"), "set_id", "left")
                      .withColumn("root", F.coalesce("root", "set_id")), "labelled")
    smallest = staged(labelled.groupBy("root").agg(F.min("first_id").alias("smallest")), "smallest")
    named = staged(labelled.join(smallest, "root").select("set_id", "smallest"), "names")
    return (rows.drop("sketch").join(named, "set_id", "left")
            .select("doc_id", "text_md5", "n_shingles", "set_id",
                    F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("smallest"))
                    .alias("component_id")))


def keep_first(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `docs`, all columns, that stay: one document of each component.

    Blank documents all stay. Of rows that repeat a kept doc_id and text one
    stays; of a component without any doc_id one of each set stays.
    """
    found = near_duplicates(docs, words, percent)
    blank = found.filter("set_id IS NULL").select("doc_id", "text_md5").distinct() \
        .withColumn("blank", F.lit(True))
    first = (found.filter("set_id IS NOT NULL AND doc_id <=> component_id")
             .groupBy(F.col("component_id").alias("doc_id"),
                      F.when(F.col("component_id").isNull(), F.col("set_id")).alias("own"))
             .agg(F.min("text_md5").alias("text_md5")).select("doc_id", "text_md5")
             .withColumn("blank", F.lit(False)))
    kept = first.unionByName(blank).select(F.col("doc_id").alias("__id"), F.col("text_md5").alias("__md5"), "blank")
    columns = docs.columns
    matched = docs.withColumn("__text_md5", F.unhex(F.md5(text_of().cast("binary")))).join(
        kept, F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.col("__text_md5") == F.col("__md5")))
    repeats = matched.filter("NOT blank").dropDuplicates(["__id", "__text_md5"])
    return repeats.unionByName(matched.filter("blank")).select(*columns)
