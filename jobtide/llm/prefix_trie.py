"""Prefix trie of rebuilt conversations: ternary search trees per range shard.

1. Distinct turns (role, text) get dictionary ids: a written table of a digest,
   an id and the turn's words. Conversations become arrays of turn ids, and are
   rebuilt: conversation c takes the first h(c) turns of conversation c - c % 20
   and then its own turns after its first h(c).
2. Equal conversations are one sequence with a count. Sequences are dealt to
   shards by ranges of their order, so that a shard's trie shares with other
   shards only nodes on the paths of its first and its last sequence.
3. A shard's sequences go into a ternary search tree, medians first, which keeps
   the siblings of a node balanced. One iterative traversal, bottom up, sums
   members, children, leaves and savings. Nodes off the two boundary paths are
   complete; the two paths leave the shard as a row each, with what hangs off
   each of their nodes inside the shard.
4. The paths, two rows per shard, meet in one task in the order of the sequences.
   It keeps a single stack, the current path, and a node is complete when the
   next path leaves it. Nodes below a boundary node then look up its conv_id.
5. The members that end at a node are hashed in ascending order: sorted ranges
   write texts of some CHUNK ids, and one hash goes over a node's texts.

Turns are ordered by turn, null first, and then by a digest of role and text.

Defined results: a null role or text is empty. Rows with a null conv_id belong
to no conversation and are ignored. Repeated rows are turns of their own. A
conversation without turns after rebuilding ends at the root. An empty table has
no nodes. Other columns are ignored. A conversation is one record: a task holds
its turn ids (8 bytes each), and a shard's.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged
from .mixing import words

FAMILY = 20        # conversations that share the first turns of the first of them
BORROWED = 4       # a conversation borrows fewer turns than this
CHUNK = 1000       # conv_ids of one text to hash
NODES_TOGETHER = 100_000
NONE = -1          # no link

PATH = ("words", "members", "least", "children", "leaves", "saved", "end")
NODE = ("least", "depth", "parent", "parent_ref", "members", "children", "leaves", "saved", "end")
SHARD = ", ".join([*(f"{c} long" for c in NODE), "shard int", "side int", "skip int", "ids array<long>",
                   *(f"p_{c} array<long>" for c in PATH)])


def borrowed(conv_id: Column) -> Column:
    """h: how many turns a conversation borrows."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % BORROWED).cast("int")


def sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, ids, words): every rebuilt conversation as arrays of turn ids and of words per turn."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", digest.alias("key"), words().cast("int").alias("words"))
    dictionary = staged(rows.groupBy("key").agg(F.min("words").alias("words"))
                        .withColumn("id", F.monotonically_increasing_id()), "turns")
    coded = rows.drop("words").join(dictionary, "key")
    in_order = F.sort_array(F.collect_list(F.struct("turn", "key", "id", "words")))
    own = staged(coded.groupBy("conv_id").agg(in_order.alias("t")).select(
        "conv_id", F.transform("t", lambda x: x["id"]).alias("ids"),
        F.transform("t", lambda x: x["words"]).alias("words")), "own-turns")
    heads = own.filter(F.col("conv_id") % FAMILY == 0).select(
        F.col("conv_id").alias("base"), F.slice("ids", 1, BORROWED).alias("head_ids"),
        F.slice("words", 1, BORROWED).alias("head_words"))
    h = F.col("h")

    def rebuilt(head, kept):
        first = F.coalesce(F.slice(head, F.lit(1), h), F.slice(kept, 1, 0))
        return F.concat(first, F.slice(kept, h + 1, F.greatest(F.size(kept) - h, F.lit(0))))

    return (own.withColumn("base", F.col("conv_id") - F.col("conv_id") % FAMILY).join(heads, "base", "left")
            .withColumn("h", borrowed(F.col("conv_id")))
            .select("conv_id", rebuilt("head_ids", "ids").alias("ids"), rebuilt("head_words", "words").alias("words")))


# ------------------------------------------------------------- one shard

def medians(n: int) -> Iterator[int]:
    """0 .. n - 1, each range's middle before its halves."""
    open_ = [(0, n)]
    while open_:
        a, b = open_.pop()
        if a < b:
            middle = (a + b) // 2
            yield middle
            open_ += [(middle + 1, b), (a, middle)]


class TernaryTree:
    """A trie whose siblings are binary search trees; node 0 is the root."""

    def __init__(self):
        self.value, self.less, self.below, self.more, self.up, self.depth, self.words = (array("q") for _ in range(7))
        self._node(NONE, NONE, 0)

    def _node(self, value: int, up: int, words: int) -> int:
        for column, x in zip((self.value, self.less, self.below, self.more, self.up, self.words),
                             (value, NONE, NONE, NONE, up, words)):
            column.append(x)
        self.depth.append(self.depth[up] + 1 if up != NONE else 0)
        return len(self.value) - 1

    def insert(self, ids: Sequence[int], words: Sequence[int]) -> int:
        """The node of the sequence."""
        value, less, more, below = self.value, self.less, self.more, self.below
        at = 0
        for k, wanted in enumerate(ids):
            links, owner, node = below, at, below[at]
            while node != NONE and value[node] != wanted:
                links, owner = (less if wanted < value[node] else more), node
                node = links[owner]
            if node == NONE:
                node = self._node(wanted, at, words[k])
                links[owner] = node
            at = node
        return at

    def path(self, node: int) -> list[int]:
        """The nodes from the root to this one."""
        out = []
        while node != NONE:
            out.append(node)
            node = self.up[node]
        return out[::-1]

    def traversal(self) -> list[int]:
        """All nodes, each after its parent."""
        out, open_ = [], [0]
        while open_:
            node = open_.pop()
            out.append(node)
            open_ += [x for x in (self.less[node], self.more[node], self.below[node]) if x != NONE]
        return out


def shard_trie(shard: int, rows: list[tuple]) -> tuple[list[tuple], list[tuple]]:
    """Nodes and boundary paths of the sorted sequences (ids, words, least conv_id, members)."""
    tree, ends = TernaryTree(), {}
    for k in medians(len(rows)):
        ends[tree.insert(rows[k][0], rows[k][1])] = k
    n = len(tree.value)
    members, children, leaves, saved = (array("q", bytes(8 * n)) for _ in range(4))
    least = array("q", [2 ** 63 - 1]) * n
    for node, k in ends.items():
        least[node], members[node] = rows[k][2], rows[k][3]
    at = {k: node for node, k in ends.items() if k in (0, len(rows) - 1)}
    paths = [tree.path(at[0]), tree.path(at[len(rows) - 1])]
    reference = {}
    for side, path in enumerate(paths):
        for d, node in enumerate(path):
            reference.setdefault(node, (shard << 33) + (side << 32) + d)
    out = []
    for node in reversed(tree.traversal()):  # children before parents
        up = tree.up[node]
        if up != NONE:
            members[up] += members[node]
            least[up] = min(least[up], least[node])
        if node in reference:
            continue
        leaves[node] = leaves[node] or 1
        saved[node] += (members[node] - 1) * tree.words[node]
        children[up] += 1
        leaves[up] += leaves[node]
        saved[up] += saved[node]
    for node in range(n):
        if node not in reference:
            up = tree.up[node]
            outer = reference.get(up)
            out.append((least[node], tree.depth[node], None if outer is not None else least[up], outer, members[node],
                        children[node], leaves[node], saved[node],
                        rows[ends[node]][2] if node in ends else None))
    sides, skip = [], 0
    for side, path in enumerate(paths):
        if side and path == paths[0]:
            break
        skip = sum(a == b for a, b in zip(path, paths[0])) if side else 0
        kept = path[skip:]
        sides.append((shard, side, skip, [tree.value[x] for x in path[1:]],
                      *([column[x] for x in kept] for column in (tree.words, members, least, children, leaves, saved)),
                      [rows[ends[x]][2] if x in ends else None for x in kept]))
    return out, sides


def _types(schema: str) -> tuple[list[str], list]:
    kinds = {"long": pa.int64(), "int": pa.int32(), "array<long>": pa.list_(pa.int64())}
    names, types = zip(*(x.split() for x in schema.split(", ")))
    return list(names), [kinds[t] for t in types]


def _batch(columns: list, schema: str) -> pa.RecordBatch:
    names, types = _types(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def shards(sequence_rows: DataFrame) -> DataFrame:
    """Nodes and boundary paths of every shard, in one table: a path has a `shard`."""
    def run(batches):
        rows, shard = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            shard = batch.column(0)[0].as_py()
            parts = []
            for column in (batch.column(1), batch.column(2)):
                flat, cuts = column.flatten().to_numpy(), np.asarray(column.offsets) - column.offsets[0].as_py()
                parts.append([flat[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())])
            rows += zip((x.tolist() for x in parts[0]), parts[1], batch.column(3).to_pylist(), batch.column(4).to_pylist())
        if not rows:
            return
        nodes, sides = shard_trie(shard, [(i, w.tolist(), c, m) for i, w, c, m in rows])
        none = len(SHARD.split(", ")) - len(NODE)
        for k in range(0, len(nodes), NODES_TOGETHER):
            some = nodes[k:k + NODES_TOGETHER]
            yield _batch([*zip(*some), *([[None] * len(some)] * none)], SHARD)
        yield _batch([*([[None] * len(sides)] * len(NODE)), *zip(*sides)], SHARD)

    parts = int(sequence_rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    distinct = sequence_rows.groupBy("ids", "words").agg(
        F.min("conv_id").alias("least"), F.count(F.lit(1)).alias("members"))
    dealt = distinct.repartitionByRange(parts, "ids").sortWithinPartitions("ids")
    return dealt.select(F.spark_partition_id().alias("shard"), "ids", "words", "least", "members").mapInArrow(run, SHARD)


# ------------------------------------------------------- boundary nodes

MERGED = ", ".join([*(f"{c} long" for c in NODE), "ref long"])


def merged_paths(rows: Iterator[dict]) -> Iterator[tuple]:
    """Boundary nodes out of the paths in order, and for each of their references its conv_id.

    The stack is the current path; a node on it is complete once a path leaves it.
    """
    stack, ids = [], []

    def close(size):
        while len(stack) > size:
            node = stack.pop()
            leaves = node["leaves"] if node["children"] else 1
            saved = node["saved"] + (node["members"] - 1) * node["words"]
            if stack:
                stack[-1]["leaves"] += leaves
                stack[-1]["saved"] += saved
            yield (node["least"], len(stack), None, stack[-1]["refs"][0] if stack else None, node["members"],
                   node["children"], leaves, saved, node["end"], None)
            yield from ((node["least"], *[None] * (len(NODE) - 1), ref) for ref in node["refs"])

    for row in rows:
        common = 0
        for a, b in zip(ids, row["ids"]):
            if a != b:
                break
            common += 1
        yield from close(common + 1)
        ids = row["ids"]
        for d in range(row["skip"], len(ids) + 1):
            own = {c: row[f"p_{c}"][d - row["skip"]] for c in PATH}
            if d < len(stack):
                node = stack[d]
                for c in ("members", "children", "leaves", "saved"):
                    node[c] += own[c]
                node["least"] = min(node["least"], own["least"])
                node["end"] = own["end"] if node["end"] is None else node["end"]
            else:
                if stack:
                    stack[-1]["children"] += 1
                stack.append({**own, "refs": []})
            stack[d]["refs"].append((row["shard"] << 33) + (row["side"] << 32) + d)
    yield from close(0)


def boundary(shard_rows: DataFrame) -> DataFrame:
    """Boundary nodes (no `ref`), and the least conv_id of each reference to one."""
    def run(batches):
        rows = (row for batch in batches for row in batch.to_pylist())
        found = []
        for row in merged_paths(rows):
            found.append(row)
            if len(found) == NODES_TOGETHER:
                yield _batch(list(zip(*found)), MERGED)
                found = []
        if found:
            yield _batch(list(zip(*found)), MERGED)

    paths = shard_rows.filter("shard IS NOT NULL").drop(*NODE)  # two rows per shard
    return paths.repartition(1).sortWithinPartitions("shard", "side").mapInArrow(run, MERGED)


# ---------------------------------------------------------------- digests

def end_digests(sequence_rows: DataFrame) -> DataFrame:
    """(end, ends_sha256): per distinct sequence its least conv_id and the digest of all its conv_ids."""
    def chunks(batches):
        open_, ids = None, []

        def text():
            return {"seq": [open_], "first": [ids[0]], "text": [",".join(map(str, ids))]}

        for batch in batches:
            for seq, conv_id in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if ids and (seq != open_ or len(ids) == CHUNK):
                    yield pa.RecordBatch.from_pydict(text(), schema)
                    ids = []
                open_ = seq
                ids.append(conv_id)
        if ids:
            yield pa.RecordBatch.from_pydict(text(), schema)

    def together(batches):  # one batch of many chunks
        held = []
        for batch in chunks(batches):
            held.append(batch)
            if len(held) == CHUNK:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held = []
        if held:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    def digests(batches):
        open_, end, state = None, None, None
        for batch in batches:
            found = []
            for seq, first, text in zip(*(c.to_pylist() for c in batch.columns)):
                if seq == open_:
                    state.update(b"," + text.encode())
                    continue
                if state is not None:
                    found.append((end, state.hexdigest()))
                open_, end, state = seq, first, hashlib.sha256(text.encode())
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found)], names=["end", "ends_sha256"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([end]), pa.array([state.hexdigest()])], names=["end", "ends_sha256"])

    schema = pa.schema([("seq", pa.binary()), ("first", pa.int64()), ("text", pa.string())])
    parts = int(sequence_rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    seq = F.unhex(F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256))
    in_order = sequence_rows.select(seq.alias("seq"), "conv_id").repartitionByRange(parts, "seq", "conv_id") \
        .sortWithinPartitions("seq", "conv_id")
    texts = in_order.mapInArrow(together, "seq binary, first long, text string")
    return texts.repartition(parts, "seq").sortWithinPartitions("seq", "first") \
        .mapInArrow(digests, "end long, ends_sha256 string")


def trie(conversations: DataFrame) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) per node."""
    rows = staged(sequences(conversations), "sequences")
    in_shards = staged(shards(rows), "shard-tries")
    merged = staged(boundary(in_shards), "boundary-nodes")
    refs = merged.filter("ref IS NOT NULL").select(F.col("ref").alias("parent_ref"), F.col("least").alias("found"))
    digests = staged(end_digests(rows), "ends")
    nodes = in_shards.filter("shard IS NULL").select(*NODE).unionByName(
        merged.filter("ref IS NULL").select(*NODE))
    parts = []
    # Rows without a key to look up stay out of the join, where they would all meet.
    for known in (nodes.filter("parent_ref IS NULL"),
                  nodes.filter("parent_ref IS NOT NULL").join(refs, "parent_ref")
                  .withColumn("parent", F.col("found")).drop("found")):
        ended = known.filter("end IS NOT NULL").join(digests, "end")
        parts += [ended.select(*NODE, "ends_sha256"), known.filter("end IS NULL").select(
            *NODE, F.lit(hashlib.sha256().hexdigest()).alias("ends_sha256"))]
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    return whole.select(
        F.col("least").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"),
        F.col("members").alias("n_convs"), F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), "ends_sha256")
