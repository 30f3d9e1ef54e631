"""Line dedup by pairwise alignment: patience diff against the first document with a line.

1. Lines become 64-bit hashes of their words (white space collapsed), blank
   lines none. Equal texts form a class; a later copy is its class's first
   document once more, so all its lines are deleted without an alignment.
2. A block can be deleted only if all its lines occur in another class, so a
   document's seeds are its runs of such lines of at least BLOCK_WORDS words
   in all. Lone boilerplate lines end here, however many documents hold them.
3. A seed line leads to the first class that holds it, whatever its frequency,
   and each pair of classes counts once: at most one pair per posting.
4. Each pair is aligned by patience diff on its whole line sequences: lines
   that are unique in both and in one order (a longest increasing
   subsequence) are anchors, equal lines next to them join, and the gaps
   between are treated the same way.
5. Runs of lines that one earlier partner aligns, of at least BLOCK_WORDS words,
   are blocks; the blocks of all partners are deleted from the later document.
   Lines that come one each from several documents are no block.
6. The first holder of a passage may hold it in another form (twice, shuffled),
   where it aligns nothing. What is not covered yet is tried with the other
   holders: a block that covers a line has all lines of one of the shortest runs
   of BLOCK_WORDS words around it, so the earlier holders of the rarest line of
   each such run are all its possible partners. They are tried in rounds, in
   the order of a hash, TRIES times as many each round, until the line is
   covered or every one of them was tried: no possible partner is left out, and
   a passage that many share is covered in the first rounds.

Counts and holders of lines are written before they are joined: both sides are
then plain shuffles, which adaptive execution can split where a line is hot.

"Earlier" is the order of doc_id, nulls last, then of a text hash.

Defined results: null and empty texts have no lines to delete and stay as they
are (null stays null). Rows equal in doc_id and text are one document and get
one result each. Other columns pass through `deduplicated`.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import binary_slices, list_array, staged, text_of

BLOCK_WORDS = 30
TRIES = 8

LINED = "id long, md5 binary, lines array<long>, words array<int>"


def patience(later: list[int], earlier: list[int]) -> list[int]:
    """Places in `later` that the alignment with `earlier` matches."""
    matched: list[int] = []
    todo = [(0, len(later), 0, len(earlier))]
    while todo:
        a, b, c, d = todo.pop()
        while a < b and c < d and later[a] == earlier[c]:
            matched.append(a)
            a, c = a + 1, c + 1
        while a < b and c < d and later[b - 1] == earlier[d - 1]:
            b, d = b - 1, d - 1
            matched.append(b)
        if a >= b or c >= d:
            continue
        anchors = _anchors(later, earlier, a, b, c, d)
        if not anchors:
            continue
        at, to = a, c
        for x, y in anchors:
            todo.append((at, x, to, y))
            matched.append(x)
            at, to = x + 1, y + 1
        todo.append((at, b, to, d))
    return sorted(matched)


def _anchors(later, earlier, a, b, c, d) -> list[tuple[int, int]]:
    """Pairs of places of lines unique on both sides, longest increasing in both."""
    def unique(lines, start, end):
        place: dict[int, int] = {}
        for k in range(start, end):
            place[lines[k]] = -1 if lines[k] in place else k
        return place

    other = unique(earlier, c, d)
    pairs = [(x, other[line]) for line, x in unique(later, a, b).items() if x >= 0 and other.get(line, -1) >= 0]
    pairs.sort()
    tails: list[int] = []
    ends: list[int] = []
    back = [-1] * len(pairs)
    for k, (_, y) in enumerate(pairs):
        at = bisect_left(tails, y)
        if at == len(tails):
            tails.append(y)
            ends.append(k)
        else:
            tails[at], ends[at] = y, k
        back[k] = ends[at - 1] if at else -1
    chain, k = [], ends[-1] if ends else -1
    while k >= 0:
        chain.append(pairs[k])
        k = back[k]
    return chain[::-1]


def long_runs(places, words, least: int = BLOCK_WORDS) -> list[int]:
    """The places in runs without a gap (blank lines, of no words, may lie inside) that
    have at least `least` words."""
    out: list[int] = []
    run: list[int] = []
    for k in sorted(places):
        if run and any(words[j] for j in range(run[-1] + 1, k)):
            out += run if sum(words[j] for j in run) >= least else []
            run = []
        run.append(k)
    return out + (run if sum(words[j] for j in run) >= least else [])


def lined(docs: DataFrame) -> DataFrame:
    """One narrow row per document: its line hashes (0 for blank) and words per line."""
    def run(batches):
        for batch in batches:
            lines, words = [], []
            for text in binary_slices(batch.column(2)):
                parts = [x.split() for x in text.split(b"\n")]
                words.append(np.array([len(p) for p in parts], np.int32))
                lines.append(np.array([xxhash.xxh3_64_intdigest(b" ".join(p)) | 1 if p else 0 for p in parts],
                                      np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), list_array(pa, lines, pa.int64()),
                 list_array(pa, words, pa.int32())], names=["id", "md5", "lines", "words"])

    return docs.select(F.col("doc_id").cast("long").alias("id"), F.unhex(F.md5(text_of().cast("binary"))).alias("md5"),
                       text_of().cast("binary").alias("text")).mapInArrow(run, LINED)


def _classes(rows: DataFrame) -> DataFrame:
    """(md5, place, lines, words): distinct texts with the place of their first document."""
    place = F.struct(F.col("id").isNull().alias("last"), "id", "md5")
    return (rows.groupBy("md5").agg(F.min(F.struct(place.alias("place"), "lines", "words")).alias("c"))
            .select("md5", "c.*"))


def _seeds(classes: DataFrame) -> DataFrame:
    """(md5, line, df, run): lines in runs that could be deleted, with their holders' number."""
    postings = classes.select("md5", F.explode(F.array_distinct("lines")).alias("line")).filter("line != 0")
    shared = staged(postings.groupBy("line").agg(F.count(F.lit(1)).alias("df")).filter("df > 1"), "shared-lines")
    per_class = postings.join(shared, "line").groupBy("md5").agg(
        F.collect_list("line").alias("shared"), F.collect_list("df").alias("dfs"))

    def run(batches):
        for batch in batches:
            keys, found, numbers, runs = [], [], [], []
            for md5, lines, words, common, dfs in zip(*(c.to_pylist() for c in batch.columns)):
                known = dict(zip(common, dfs))
                places = long_runs([k for k, x in enumerate(lines) if x in known], words)
                number, before, seen = 0, None, set()
                for k in places:
                    if before is not None and any(words[before + 1:k]):
                        number += 1
                    before = k
                    if lines[k] not in seen:
                        seen.add(lines[k])
                        keys.append(md5)
                        found.append(lines[k])
                        numbers.append(known[lines[k]])
                        runs.append(number)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.array(found, pa.int64()), pa.array(numbers, pa.int64()),
                 pa.array(runs, pa.int32())], names=["md5", "line", "df", "run"])

    return classes.join(per_class, "md5").select("md5", "lines", "words", "shared", "dfs").mapInArrow(
        run, "md5 binary, line long, df long, run int")


def first_holders(classes: DataFrame, seeds: DataFrame) -> DataFrame:
    """(line, first): the place of the first class that holds each seed line."""
    # The first holder may be any class that has the line, with a run of its own or not.
    lines = staged(seeds.select("line").distinct(), "seed-lines")
    return staged(classes.select("place", F.explode(F.array_distinct("lines")).alias("line"))
                  .join(lines, "line", "left_semi").groupBy("line").agg(F.min("place").alias("first")), "holders")


def pairs(seeds: DataFrame) -> DataFrame:
    """(later, earlier): each class with the first classes that hold its `seeds`, of (md5, line, df, first)."""
    return seeds.select(F.col("md5").alias("later"), F.col("first.md5").alias("earlier")).distinct()


def aligned(classes: DataFrame, both: DataFrame) -> DataFrame:
    """(md5, places): the lines of each class in blocks that one earlier partner aligns,
    for the pairs (later, earlier) in `both`."""
    both = (both
            .join(classes.select(F.col("md5").alias("earlier"), F.col("lines").alias("theirs")), "earlier")
            .join(classes.select(F.col("md5").alias("later"), F.col("lines").alias("own"), "words"), "later")
            .select("later", "own", "words", "theirs"))

    def run(batches):
        for batch in batches:
            keys, found = [], []
            for md5, own, words, theirs in zip(*(c.to_pylist() for c in batch.columns)):
                keep = [k for k, x in enumerate(own) if x]
                places = patience([own[k] for k in keep], [x for x in theirs if x])
                keys.append(md5)
                found.append(long_runs([keep[k] for k in places], words))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(found, pa.list_(pa.int32()))],
                                             names=["md5", "places"])

    return _united(both.mapInArrow(run, "md5 binary, places array<int>").filter(F.size("places") > 0))


def _united(found: DataFrame) -> DataFrame:
    return found.groupBy("md5").agg(F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"))


def probe_lines(lines: list[int], words: list[int], df: dict[int, int], done: set[int]) -> set[int]:
    """The rarest line of each shortest run of BLOCK_WORDS words, of lines in `df`, around
    a place that is not `done`. Any block that covers such a place has all lines of one of these runs."""
    runs: list[list[int]] = []
    for k in long_runs([k for k, x in enumerate(lines) if x in df], words):
        if runs and not any(words[runs[-1][-1] + 1:k]):
            runs[-1].append(k)
        else:
            runs.append([k])
    probes = set()
    for run in runs:
        for at, k in enumerate(run):
            if k in done:
                continue
            total, start, end = words[k], at, at
            while True:  # the shortest end for each start, until the run ends at the place itself
                while total < BLOCK_WORDS and end + 1 < len(run):
                    end += 1
                    total += words[run[end]]
                while end > at and total - words[run[end]] >= BLOCK_WORDS:
                    total -= words[run[end]]
                    end -= 1
                if total >= BLOCK_WORDS:
                    probes.add(min((lines[j] for j in run[start:end + 1]), key=lambda x: (df[x], x)))
                    if end == at:
                        break
                if not start:
                    break
                start -= 1
                total += words[run[start]]
    return probes


def _open(rows: DataFrame, tried: int) -> DataFrame:
    """The classes that have a line left to cover, with its `probes`: lines of which more
    than `tried` holders may be left."""
    def run(batches):
        for batch in batches:
            probes = []
            for lines, words, held, done in zip(*(batch.column(c).to_pylist()
                                                  for c in ("lines", "words", "held", "done"))):
                df = {x["line"]: x["df"] for x in held}
                probes.append([{"line": x, "df": df[x]} for x in sorted(probe_lines(lines, words, df, set(done)))
                               if df[x] > tried])
            column = pa.array(probes, pa.list_(pa.struct([("line", pa.int64()), ("df", pa.int64())])))
            yield batch.append_column("probes", column).filter(pa.array([bool(p) for p in probes], pa.bool_()))

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{schema}, probes array<struct<line: bigint, df: bigint>>")


def covered(classes: DataFrame) -> DataFrame:
    """(md5, places): the lines of each class in a block of any earlier class."""
    seeds = staged(_seeds(classes), "seeds")
    # Only lines with an earlier holder can be covered.
    seeds = staged(seeds.join(first_holders(classes, seeds), "line").join(classes.select("md5", "place"), "md5")
                   .filter(F.col("first") < F.col("place")).select("md5", "line", "df", "first"), "earlier-seeds")
    blocks = found = staged(aligned(classes, pairs(seeds)), "blocks")
    held = seeds.groupBy("md5").agg(F.collect_list(F.struct("line", "df")).alias("held"))
    none = F.expr("CAST(array() AS array<int>)")
    left, tried, until, holders = classes.join(held, "md5").withColumn("done", none), 0, TRIES, None
    while True:
        left = left.join(found, "md5", "left").withColumn(
            "done", F.array_union("done", F.coalesce("places", none))).select("md5", "place", "lines", "words", "held", "done")
        left = staged(_open(left, tried), "open")
        probes = left.select("md5", "place", F.inline("probes"))
        if probes.isEmpty():
            return _united(blocks)
        if holders is None:  # `turn` is below df: after as many tries none is left
            turn = F.pmod(F.xxhash64("line", "md5"), F.lit(1 << 20)) / (1 << 20) * F.col("df")
            holders = staged(classes.select("md5", "place", F.explode(F.array_distinct("lines")).alias("line"))
                             .join(staged(probes.select("line", "df").distinct(), "probes"), "line")
                             .select("line", F.col("md5").alias("earlier"), F.col("place").alias("before"),
                                     turn.alias("turn")), "probe-holders")
        both = (probes.join(holders.filter((F.col("turn") >= tried) & (F.col("turn") < until)), "line")
                .filter(F.col("before") < F.col("place")).select(F.col("md5").alias("later"), "earlier").distinct())
        found = staged(aligned(classes, staged(both, "tries")), "blocks")
        blocks = blocks.unionByName(found)
        left, tried, until = left.drop("probes"), until, until * TRIES


def deleted_lines(docs: DataFrame) -> DataFrame:
    """(id, md5, lines, deleted) per distinct (doc_id, text): its number of lines and the
    places, from 0, of those to delete."""
    rows = staged(lined(docs).distinct(), "lines")
    classes = staged(_classes(rows), "line-classes")
    blocks = covered(classes).select("md5", F.array_sort("places").alias("deleted"))
    firsts = classes.select("md5", F.col("place.id").alias("first")).join(blocks, "md5", "left")
    none = F.expr("CAST(array() AS array<int>)")
    every = F.filter(F.transform("words", lambda w, k: F.when(w > 0, k)), lambda k: k.isNotNull())
    return rows.join(firsts, "md5").select(
        "id", "md5", F.size("lines").cast("long").alias("lines"),
        F.when(F.col("id").eqNullSafe(F.col("first")), F.coalesce("deleted", none)).otherwise(every).alias("deleted"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """The columns of `docs`, `text` without the deleted lines, and `__lines` and `__deleted`."""
    found = deleted_lines(docs).select(F.col("id").alias("__id"), F.col("md5").alias("__md5"),
                                       F.col("lines").alias("__lines"), F.col("deleted").alias("__deleted"))
    keyed = docs.withColumn("__key", F.unhex(F.md5(text_of().cast("binary"))))
    kept = F.array_join(F.transform(F.array_except(
        F.sequence(F.lit(0), F.size(F.col("__parts")) - 1), F.col("__deleted")),
        lambda k: F.get("__parts", k)), "\n")
    return (keyed.join(found, F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.col("__key") == F.col("__md5")))
            .withColumn("__parts", F.split("text", "\n", -1))
            .select(*(F.when(F.size("__deleted") > 0, kept).otherwise(F.col("text")).alias(c) if c == "text"
                      else F.col(c) for c in docs.columns), "__lines", "__deleted"))
