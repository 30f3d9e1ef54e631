"""Near duplicates against brute force over all pairs; nulls, blanks, ties, repeats, clashes."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest_llm import prose

from jobtide.llm import minhash_dedup as M
from jobtide.llm.common import WordHashes, shingle_set


def brute(rows, words, percent):
    def shingles(text):
        w = (text or "").encode().lower().split()
        if not w:
            return frozenset()
        return frozenset(tuple(w[k:k + words]) for k in range(max(1, len(w) - words + 1)))

    sets = [shingles(t) for _, t, *_ in rows]
    group = list(range(len(rows)))

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                group[root(a)] = root(b)
    out = []
    for a, row in enumerate(rows):
        ids = [rows[b][0] for b in range(len(rows)) if root(b) == root(a) and rows[b][0] is not None]
        out.append((row[0], len(sets[a]), min(ids, default=None) if sets[a] else row[0]))
    return sorted(out, key=repr)


def edited(words, times, rng):
    words = list(words)
    for _ in range(times):
        words[rng.randrange(len(words))] = f"edit{rng.random()}"
    return " ".join(words)


def family_rows():
    rng = random.Random(3)
    base = prose(120).split()
    rows = [(k, edited(base, rng.randrange(0, 9), rng)) for k in range(60)]
    rows += [(100 + k, edited(prose(400, 5).split(), rng.randrange(0, 20), rng)) for k in range(20)]
    rows += [(200, None), (201, ""), (202, " \t\n"), (203, "one"), (204, "ONE"), (205, "one two"), (206, "one two"),
             (None, "one two"), (207, "É e"), (208, "é e"), (0, rows[0][1]), (0, "another text of the same id"),
             (300, prose(20_000, 9)), (301, prose(20_000, 9) + " tail"), (302, prose(120) + " " + prose(120, 7))]
    return rows


@pytest.mark.parametrize("words,percent,block", [(3, 85, 8), (5, 80, M.BLOCK)])
def test_components_match_brute_force(documents, monkeypatch, words, percent, block):
    """Families in one block and, with small blocks, in many, by members or by shingles."""
    monkeypatch.setattr(M, "BLOCK", block)
    monkeypatch.setattr(M, "BLOCK_SHINGLES", 3000 if block == M.BLOCK else 1 << 20)
    rows = family_rows()
    found = M.near_duplicates(documents(rows), words, percent)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found.collect()), key=repr)
    assert got == brute(rows, words, percent)


def test_one_document_of_each_group_stays(documents):
    rows = [(5, prose(60)), (3, prose(60) + " end"), (3, prose(60) + " end"), (9, prose(60, 2)), (7, None), (7, None),
            (8, " "), (None, prose(60, 4)), (None, prose(60, 4))]
    docs = documents(rows)
    kept = M.keep_first(docs)
    assert kept.columns == docs.columns
    got = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in kept.collect())
    assert got == sorted([(False, 3, prose(60) + " end"), (False, 9, prose(60, 2)), (False, 7, ""), (False, 7, ""),
                          (False, 8, " "), (True, 0, prose(60, 4))])


@pytest.mark.parametrize("words,percent", [(3, 85), (5, 80)])
def test_recall_of_true_links(spark, words, percent):
    """Every id divisible by 50 of the given table against all its rows."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    component = {r.doc_id: r.component_id for r in M.near_duplicates(docs, words, percent).collect()}
    hashes, sets, holders = WordHashes(), {}, defaultdict(list)
    for r in docs.select("doc_id", "text").collect():
        sets[r.doc_id] = shingle_set(hashes.of((r.text or "").encode().lower().split()), words)
        for value in sets[r.doc_id].tolist():
            holders[value].append(r.doc_id)
    links = found = 0
    for q in (i for i in sets if i % 50 == 0):
        shared = Counter(x for value in sets[q].tolist() for x in holders[value])
        for x, n in shared.items():
            if x != q and 100 * n >= percent * (len(sets[q]) + len(sets[x]) - n):
                links, found = links + 1, found + (component[x] == component[q])
    print(f"\n{words} words, {percent} %: {found} of {links} links found")
    assert links > 50 and found >= 0.9 * links


def test_empty_table(documents):
    assert M.near_duplicates(documents([])).count() == 0


@settings(max_examples=60, deadline=None, derandomize=True)
@given(st.integers(1, 200), st.integers(0, 40), st.sampled_from([80, 85]))
def test_linked_sets_share_the_needed_values(size, changed, percent):
    rng = np.random.default_rng(size * 41 + changed)
    a = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64))
    b = np.unique(np.concatenate([a[min(changed, len(a)):], rng.integers(0, 1 << 63, changed // 2).astype(np.uint64)]))
    both = len(np.intersect1d(a, b))
    if len(b) and 100 * both >= percent * (len(a) + len(b) - both):
        shared = len(np.intersect1d(a[:M.SKETCH], b[:M.SKETCH]))
        for s in (a, b):
            needed = -(-len(s) * M.needed_percent(percent) // 100) if len(s) <= M.SKETCH else M.needed_large(percent)
            assert shared >= needed
