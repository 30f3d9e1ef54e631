"""Benchmark decontamination: size-partitioned MinHash containment, verified exactly.

Texts are composed (NFC) and lower-cased; words are runs of letters and digits,
of any script. Texts are sets of word shingles; an item of fewer words than a
shingle is one shingle, its whole sequence, and documents are probed for windows
of that length too. A document is contaminated if it contains at least `percent`
of an item's shingles, however long the document is.

Signatures of whole documents cannot find a short item in a long text (their
Jaccard similarity is near 0), so the MinHash sketches are of the items: the
items are partitioned by size, an item keeps its smallest shingle hashes, and
its partition says how many of them a document must hold (failing under 1e-9;
items up to the sketch size are held in full and never fail). One pass over
the documents probes every shingle of the whole text against the retained
values; candidates are verified on full shingle sets.

The items are the stated query set. They are a written table dealt into blocks of
about BLOCK_SHINGLES shingles (32 MB of hashes), and one pass over the documents
takes one block, so neither the driver nor a task holds more than a block. A pass
is narrow; with several blocks the rows are written between passes.

Defined results: items without words match nothing, nor do null texts. Repeated
items are each reported; items with null ids count as matches but are not listed.
Repeated documents are each judged. Other columns pass through `uncontaminated`.
"""

from __future__ import annotations

import math
import re
import string
import unicodedata
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, list_array, mixed, staged, text_of, window_hashes

SKETCH = 64
MISS = 1e-9
BLOCK_SHINGLES = 4_000_000
MATCHES = "array<struct<item_id: long, share: double>>"

WORD = re.compile(r"[^\W_]+")
# The same for ASCII, faster: A-Z in lower case; punctuation and control characters as spaces.
NORMAL = str.maketrans(
    string.ascii_uppercase + string.punctuation + "".join(map(chr, range(32))) + "\x7f",
    string.ascii_lowercase + " " * (len(string.punctuation) + 33))


def normal_words(text: str) -> list[str]:
    if text.isascii():
        return text.translate(NORMAL).split()
    return WORD.findall(unicodedata.normalize("NFC", text).lower())


def windows_of(hashes: np.ndarray, lengths: Iterable[int], words: int) -> np.ndarray:
    """Hashes of the windows of each of these lengths; those under `words` are kept apart."""
    parts = [window_hashes(hashes, n) if n == words else mixed(window_hashes(hashes, n) + np.uint64(n)) for n in lengths]
    return np.concatenate(parts) if parts else np.empty(0, np.uint64)


def retained_needed(size: int, percent: int) -> int:
    """Retained values that a containing document holds, by the item's size partition."""
    if size <= SKETCH:
        return -(-size * percent // 100)
    p, tail = percent / 100, 0.0
    for held in range(SKETCH + 1):
        tail += math.comb(SKETCH, held) * p ** held * (1 - p) ** (SKETCH - held)
        if tail > MISS:
            return max(1, held)
    return SKETCH


def item_sets(items: DataFrame, words: int) -> tuple[DataFrame, int]:
    """(item_id, length, shingles, block) of the items that have words, and the number of blocks.

    `length` is the words of a shingle: fewer than `words` if the item has no more.
    """
    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            lengths, sets = [], []
            for text in batch.column(1).to_pylist():
                own = hashes.of(normal_words(text))
                lengths.append(min(words, len(own)))
                sets.append(np.unique(windows_of(own, lengths[-1:] if len(own) else (), words)).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lengths, pa.int32()), list_array(pa, sets, pa.int64())],
                names=["item_id", "length", "shingles"])

    rows = items.select(F.col("item_id").cast("long").alias("item_id"), text_of().alias("text"))
    sets = rows.mapInArrow(run, "item_id long, length int, shingles array<long>").filter("length > 0")
    sets = staged(sets, "items")
    total = sets.agg(F.sum(F.size("shingles"))).first()[0] or 0
    blocks = max(1, -(-total // BLOCK_SHINGLES))
    return sets.withColumn("block", F.pmod(F.xxhash64("item_id", "shingles"), F.lit(blocks))), int(blocks)


class Index:
    """The retained values of a block of items (item_id, length, shingles) and their full sets."""

    def __init__(self, items: pa.Table, words: int, percent: int):
        items = items.combine_chunks()
        self.ids = items.column("item_id").to_pylist()
        self.lengths = sorted(set(items.column("length").to_pylist()))
        self.sets = [np.asarray(x.values).view(np.uint64) for x in items.column("shingles")]
        self.words, self.percent = words, percent
        self.needed = np.array([retained_needed(len(s), percent) for s in self.sets], int)
        kept = [s[:SKETCH] for s in self.sets]
        flat = np.concatenate(kept) if kept else np.empty(0, np.uint64)
        owners = np.repeat(np.arange(len(kept)), [len(k) for k in kept])
        order = np.argsort(flat, kind="stable")
        self.values, starts = np.unique(flat[order], return_index=True)
        self.starts = np.append(starts, len(flat))
        self.owners = owners[order]
        bits = max(10, (16 * max(1, len(self.values))).bit_length())
        self.shift = np.uint64(64 - bits)
        self.maybe = np.zeros(1 << bits, bool)
        self.maybe[self.values >> self.shift] = True

    def matches(self, hashes: np.ndarray) -> list[tuple[int | None, float]]:
        """(item id, share of its shingles that the document holds) for contained items.

        `hashes` are those of the document's words.
        """
        windows = windows_of(hashes, self.lengths, self.words)
        probes = windows[self.maybe[windows >> self.shift]]
        if not len(probes):
            return []
        probes = np.unique(probes)
        at = np.searchsorted(self.values, probes)
        at = at[(at < len(self.values)) & (self.values[np.minimum(at, len(self.values) - 1)] == probes)]
        if not len(at):
            return []
        owners = np.concatenate([self.owners[self.starts[x]:self.starts[x + 1]] for x in at])
        counts = np.bincount(owners, minlength=len(self.sets))
        found, own = [], None
        for k in np.flatnonzero((counts >= self.needed) & (counts > 0)).tolist():
            own = np.unique(windows) if own is None else own
            held = len(np.intersect1d(self.sets[k], own, assume_unique=True))
            if 100 * held >= self.percent * len(self.sets[k]):
                found.append((self.ids[k], held / len(self.sets[k])))
        return found


def with_matches(docs: DataFrame, items: DataFrame, words: int = 5, percent: int = 80,
                 carry: tuple[str, ...] | None = None, into: str = "__matches") -> DataFrame:
    """The columns `carry` of every row (default: all) and `into`: the contained items."""
    carry = tuple(docs.columns) if carry is None else carry
    sets, blocks = item_sets(items, words)
    whole = list(dict.fromkeys([*carry, "text"]))
    flow = docs.select(*whole, F.lit(None).cast(MATCHES).alias(into))
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("share", pa.float64())]))
    at = whole.index("text")
    for block in range(blocks):
        index = Index(sets.filter(F.col("block") == block).select("item_id", "length", "shingles").toArrow(), words, percent)
        last = block == blocks - 1
        out = list(carry) if last else whole

        def run(batches, index=index, out=out):
            hashes = WordHashes()
            for batch in batches:
                found = [index.matches(hashes.of(normal_words(t or ""))) for t in batch.column(at).to_pylist()]
                before = batch.column(len(whole)).to_pylist()
                both = [(old or []) + [{"item_id": i, "share": s} for i, s in new]
                        for old, new in zip(before, found)]
                yield pa.RecordBatch.from_arrays([*(batch.column(whole.index(c)) for c in out),
                                                  pa.array(both, kind)], names=[*out, into])

        flow = flow.mapInArrow(run, flow.select(*out, into).schema)
        if not last:
            flow = staged(flow, "matches")
    return flow


def uncontaminated(docs: DataFrame, items: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `docs`, all columns, that contain no item."""
    into = "__matches"
    while into in docs.columns:
        into += "_"
    return with_matches(docs, items, words, percent, into=into).filter(F.size(into) == 0).drop(into)
