"""Prefix trie of conversations: shards and their merging, and the whole operator, by brute force."""

import hashlib
import random
import zlib
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from jobtide.llm import prefix_trie as P

SCHEMA = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
    T.StructField("text", T.StringType()),
    *(T.StructField(n, T.LongType()) for n in ("ids", "words", "key", "id", "least", "depth", "shard", "seq", "h", "t"))])


def brute_nodes(convs, words):
    """Rows per node of {conv_id: tuple of turns}; words(turn) counts its words."""
    members, ends = defaultdict(list), defaultdict(list)
    for c, seq in convs.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
        ends[seq].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(m) - 1) * words(p[-1]) if p else 0
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), children[p], leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()) for p, m in members.items())


def sharded_nodes(convs, cuts):
    """The same without digests, through shards of the sorted distinct sequences and merged paths."""
    classes = defaultdict(list)
    for c, seq in convs.items():
        classes[seq].append(c)
    rows = [(list(s), [x % 5 for x in s], min(m), len(m)) for s, m in sorted(classes.items())]
    nodes, paths, at = [], [], 0
    for shard, cut in enumerate([*cuts, len(rows)]):
        cut = min(max(cut, at), len(rows))
        if cut > at:
            found, sides = P.shard_trie(shard, rows[at:cut])
            nodes += found
            names = ["shard", "side", "skip", "ids", *(f"p_{c}" for c in P.PATH)]
            paths += [dict(zip(names, map(lambda x: x if isinstance(x, int) else list(x), side))) for side in sides]
        at = cut
    merged = list(P.merged_paths(iter(paths)))
    least = {r[-1]: r[0] for r in merged if r[-1] is not None}
    nodes += [r[:-1] for r in merged if r[-1] is None]
    out = []
    for c, depth, parent, ref, n, children, leaves, saved, end in nodes:
        parent = least[ref] if ref is not None else -1 if parent is None else parent
        out.append((c, depth, parent, n, children, leaves, saved, end))
    return sorted(out, key=lambda r: r[:7]), {min(m): s for s, m in classes.items()}


@settings(max_examples=300, deadline=None, derandomize=True)
@given(st.dictionaries(st.integers(0, 60), st.lists(st.integers(0, 3), max_size=6).map(tuple), min_size=1, max_size=30),
       st.lists(st.integers(0, 30), max_size=6).map(sorted))
def test_shards_merge_to_the_whole_trie(convs, cuts):
    got, firsts = sharded_nodes(convs, cuts)
    expected = brute_nodes(convs, lambda x: x % 5)
    assert [r[:7] for r in got] == [r[:7] for r in expected]
    assert {r[7] for r in got if r[7] is not None} == set(firsts)
    assert all(len(firsts[r[7]]) == r[1] for r in got if r[7] is not None)


def test_a_tree_of_deep_and_wide_sequences():
    deep = {c: tuple(range(3000 + c)) for c in range(4)}
    wide = {10 + k: (7, k) for k in range(3000)}
    got, _ = sharded_nodes({**deep, **wide}, [2, 3, 700])
    assert len(got) == 1 + 3003 + 1 + 3000
    root = got[0]
    assert root[:6] == (0, 0, -1, 3004, 2, 3001)
    tree = P.TernaryTree()
    for k in P.medians(4096):
        tree.insert([k], [1])
    steps, node = 0, tree.below[0]
    while node != P.NONE:  # a side of the balanced siblings is as deep as the logarithm
        steps, node = steps + 1, tree.less[node]
    assert steps <= 13 and sorted(P.medians(4096)) == list(range(4096))


def rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own[c].append((turn is not None, turn or 0, key, (role, text)))
    turns = {c: [x[3] for x in sorted(t)] for c, t in own.items()}
    out = {}
    for c, t in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        out[c] = tuple(turns.get(base, [])[:h] + t[h:])
    return out


def assert_trie(spark, rows):
    table = spark.createDataFrame([(*r, *(7,) * 10) for r in rows], SCHEMA)
    got = sorted(tuple(-1 if x is None else x for x in r) for r in P.trie(table).collect())
    assert got == brute_nodes(rebuilt(rows), lambda turn: len(turn[1].encode().split()))


def test_whole_operator(spark, monkeypatch):
    monkeypatch.setattr(P, "CHUNK", 3)
    rng = random.Random(5)
    texts = ["a b c", "", None, "a  b\nc", "x\u00a0y z", "long " * 400]
    rows = []
    for c in [*range(0, 130), 400, 401, 433, -40, -39, -21, 10 ** 15]:
        for turn in range(rng.randrange(1, 7)):
            rows.append((c, rng.choice([turn, turn, turn, None]), rng.choice(["user", "bot", None]), rng.choice(texts)))
    rows += [(c, k, "user", f"turn {k}") for c in range(1000, 1080) for k in range(4)]     # one conversation, often
    rows += [(c, k, "user", f"turn {k if k < 3 else c}") for c in range(1100, 1180) for k in range(5)]
    rows += [rows[5]] * 3 + [(None, 1, "user", "no conversation"), (1000, 0, "user", "turn 0")]
    rng.shuffle(rows)
    assert_trie(spark, rows)


def test_few_rows(spark):
    assert_trie(spark, [(5, 0, "a", "one turn")])
    assert_trie(spark, [(1, 0, "a", "x")])
    assert P.trie(spark.createDataFrame([], SCHEMA)).count() == 0
    assert P.trie(spark.createDataFrame([(None, 1, "a", "b", *(7,) * 10)], SCHEMA)).count() == 0
