"""Token files, line dedup, sharding, secrets and mixing."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest_llm import prose
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from jobtide.llm import common as C
from jobtide.llm import line_dedup as LD
from jobtide.llm import mixing as X
from jobtide.llm import secrets as S
from jobtide.llm import sharding as H
from jobtide.llm import token_files as T
from jobtide.llm.common import staged_path


@settings(max_examples=80, deadline=None, derandomize=True)
@given(st.lists(st.integers(0, 5000), min_size=0, max_size=300))
def test_elias_fano_round_trip(steps):
    values = np.cumsum([0, *steps])
    code = T.EliasFano.encode(values)
    again = T.EliasFano(code.count, code.width, code.low, code.high, code.places)
    assert again.all().tolist() == values.tolist()
    assert [again.select(k) for k in range(len(values))] == values.tolist()
    assert 8 * (len(code.low) + len(code.high)) <= len(values) * (2 + code.width + 1) + 24
    with pytest.raises(IndexError):
        again.select(len(values))


def tokens(path, texts):
    from tokenizers import Tokenizer
    encode = Tokenizer.from_file(path).encode
    return [encode(t or "", add_special_tokens=False).ids + [1] for t in texts]


def test_token_files_give_back_every_id(spark, documents, monkeypatch):
    import public_tokenizers
    path = public_tokenizers.path("word_bpe_49k.json")
    monkeypatch.setattr(T, "SEGMENT_IDS", 50)
    rows = [(9, "Hello  World's\tend"), (4, None), (2, ""), (2, "b"), (2, "a"), (7, "a<|endoftext|>b é́ Ǆ ﬁ"), (7, "x y"),
            (None, "last of all"), (11, prose(5000)), (5, "one\x0btwo\x85three four"), (5, "one\x0btwo\x85three four")]
    folder = staged_path(spark, "tokens-test")
    T.write_tokens(documents(rows), path, folder)
    got = T.read_tokens(spark, folder).orderBy("start").collect()
    assert [r.doc_id for r in got] == [2, 2, 2, 4, 5, 5, 7, 7, 9, 11, None]
    assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got)])[:-1].tolist()
    expected = Counter((i, len(x), zlib.crc32(np.array(x, "<u4").tobytes()))
                       for (i, _), x in zip(rows, tokens(path, [t for _, t in rows])))
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == expected
    folder = staged_path(spark, "tokens-test")
    T.write_tokens(documents([]), path, folder)
    assert T.read_tokens(spark, folder).count() == 0


def test_patience_aligns_unique_lines_in_order():
    assert LD.patience([1, 2, 3, 4, 5], [9, 2, 3, 8, 5]) == [1, 2, 4]
    assert LD.patience([1, 2, 3], [3, 2, 1]) in ([0], [1], [2])
    assert LD.patience([7, 7, 1, 7], [7, 1, 7, 7]) == [0, 2, 3]
    assert LD.patience([], [1]) == []


@settings(max_examples=100, deadline=None, derandomize=True)
@given(st.lists(st.integers(0, 12), max_size=30), st.lists(st.integers(0, 12), max_size=30))
def test_alignment_is_a_common_subsequence(a, b):
    at = 0
    for k in LD.patience(a, b):
        at = b.index(a[k], at) + 1
    assert LD.patience(a, a) == list(range(len(a)))


def test_blocks_go_from_the_later_document(documents):
    passage = "\n".join(prose(11, 50 + k) for k in range(5))
    own = ["\n".join(prose(9, 100 * d + k) for k in range(4)) for d in range(1, 12)]
    boiler = "Licensed to all."
    rows = [(1, own[0] + "\n" + passage + "\n" + boiler), (2, passage + "\n\n" + own[1] + "\n" + boiler),
            (3, own[2] + "\n" + passage.replace("\n", "\n \n") + "\n" + own[3]), (4, own[4] + "\n" + boiler),
            (5, own[0] + "\n" + passage + "\n" + boiler), (5, own[0] + "\n" + passage + "\n" + boiler),
            (6, None), (7, ""), (None, passage), (8, "\n".join(prose(3, 900 + k) for k in range(3000)))]
    docs = documents(rows)
    out = LD.deduplicated(docs)
    assert out.columns == [*docs.columns, "__lines", "__deleted"]
    got = sorted(((r.doc_id is None, r.doc_id, r.text) for r in out.collect()), key=repr)
    expected = [(1, rows[0][1]), (2, "\n" + own[1] + "\n" + boiler), (3, own[2] + "\n \n \n \n \n".replace("\n \n \n \n \n", "\n \n \n \n ") + "\n" + own[3]),
                (4, rows[3][1]), (5, ""), (5, ""), (6, None), (7, ""), (8, rows[9][1])]
    assert got == sorted([(False, *e) for e in expected] + [(True, None, "")], key=repr)
    assert LD.deduplicated(documents([])).count() == 0


def test_lines_of_several_documents_are_no_block(documents):
    lines = [prose(12, 300 + k) for k in range(3)]
    rows = [(k, lines[k] + "\n" + prose(9, 400 + k)) for k in range(3)] + [(9, "\n".join(lines))]
    assert {r.doc_id: r["__deleted"] for r in LD.deduplicated(documents(rows)).collect()} == {0: [], 1: [], 2: [], 9: []}


@pytest.mark.parametrize("other_form", ["twice", "reversed"])
def test_a_first_holder_of_another_form_hides_no_partner(documents, other_form):
    lines = [prose(11, 500 + k) for k in range(5)]
    first = "\n".join([*lines, prose(4, 600), *lines] if other_form == "twice" else lines[::-1])
    rows = [(1, first), *((k, "\n".join([prose(9, 700 + k), *lines, prose(9, 800 + k)])) for k in range(2, 16))]
    got = {r.doc_id: r["__deleted"] for r in LD.deduplicated(documents(rows)).collect()}
    assert got == {1: [], 2: [], **{k: [1, 2, 3, 4, 5] for k in range(3, 16)}}


def brute_blocks(rows):
    """Deleted places per doc_id, from an alignment with every earlier document."""
    earlier, found = {}, {}
    for k, text in sorted(rows):
        lines = [" ".join(x.split()) for x in text.split("\n")]
        words = [len(x.split()) for x in lines]
        places = [j for j, n in enumerate(words) if n]
        own = [lines[j] for j in places]
        deleted = set(places) if text in earlier else set()
        for theirs in earlier.values() if not deleted else ():
            deleted |= set(LD.long_runs([places[j] for j in LD.patience(own, theirs)], words))
        earlier.setdefault(text, own)
        found[k] = sorted(deleted)
    return found


def test_blocks_match_brute_force_over_all_earlier_documents(documents):
    rng = random.Random(12)
    hot = [prose(n, 7000 + n) for n in (4, 9, 16, 31)]
    rows = []
    for group in range(40):
        pool = [prose(rng.randrange(3, 18), 8000 + 20 * group + k) for k in range(8)]
        for _ in range(12):
            start = rng.randrange(5)
            part = pool[start:start + rng.randrange(2, 6)]
            form = rng.randrange(5)
            lines = [part, part + part, part[::-1], rng.sample(part, len(part)), part][form]
            lines = [x for x in lines if rng.random() < 0.9]
            for extra in rng.sample(hot, rng.randrange(3)) + [""] * rng.randrange(2) + [prose(12, 9000 + len(rows))]:
                lines.insert(rng.randrange(len(lines) + 1), extra)
            rows.append((len(rows), "\n".join(lines)))
    rng.shuffle(rows)
    rows = [(k, text) for k, (_, text) in enumerate(rows)]
    expected = brute_blocks(rows)
    assert sum(map(bool, expected.values())) > 50
    assert {r.doc_id: r["__deleted"] for r in LD.deduplicated(documents(rows)).collect()} == expected


def sizes_of(rows):
    return [len((t or "").encode()) + 1 for _, t, *_ in rows]


def test_shards_are_equal_in_bytes_and_gapless(documents):
    rng = random.Random(4)
    rows = [(k, prose(rng.randrange(0, 60), k)) for k in range(700)]
    rows += [(None, None), (None, "é"), (3, ""), (3, "")] + [(42, "the same row")] * 500
    got = H.sharded(documents(rows), shards=16).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (i, n, zlib.crc32((t or "").encode())) for (i, t), n in zip(rows, sizes_of(rows)))
    loads = Counter()
    for r in got:
        loads[r.shard] += r.size
    assert set(loads) == set(range(16))
    assert max(loads.values()) - min(loads.values()) <= max(sizes_of(rows))
    for shard in range(16):
        places = sorted(r.slot for r in got if r.shard == shard)
        assert places == list(range(len(places)))
    assert {r.law for r in got} == {"bytes"} and {r.grown_shard for r in got} == {None}
    assert H.sharded(documents([]), shards=16).count() == 0


def test_growing_edits_the_map_and_moves_rows_into_the_new_shard(documents, spark):
    rows = H.records(documents([(k, prose(k % 40, k)) for k in range(3000)])).cache()
    totals = H.slot_totals(rows).cache()
    first = H.rebalanced(H.first_map(spark, 4), totals, 4).cache()
    second = H.rebalanced(first, totals, 5).cache()
    assert {(r.version, r.shards) for r in second.collect()} == {(2, 5)}
    assert second.count() == H.SLOTS == second.select("slot").distinct().count()
    loads = {r.shard: r.b for r in second.join(totals, "slot").groupBy("shard").agg(F.sum("bytes").alias("b")).collect()}
    assert max(loads.values()) < 1.02 * min(loads.values())
    moved = first.alias("a").join(second.alias("b"), "slot").filter("a.shard != b.shard").join(totals, "slot")
    share = moved.agg(F.sum("bytes")).first()[0] / sum(loads.values())
    assert share < 0.25


def brute_secrets(text):
    spans = []
    for rank, rule in enumerate(S.RULES):
        flags = re.A
        spans += [(m.start(), rank, m.end(), rule.kind) for m in re.finditer(rule.pattern, text or "", flags)
                  if len(m.group(rule.group)) >= rule.least]
    return sorted(spans)


def test_findings_match_brute_force_and_scans_are_incremental(spark, documents):
    rng = random.Random(8)
    bits = ["token=abcdef", "token: short", "token=token: abcdefgh", "API_KEY = 'x.y/z+=-1'", "AKIA" + "A1" * 8, "AKIA12",
            "deadbeef" * 3, "deadbeef" * 2, "gh" + "p_" + "a1" * 18, "é𝄞 ", "\n", " plain ", "PassWD:\"hunter22\""]
    rows = [(k, "".join(rng.choice(bits) for _ in range(rng.randrange(0, 12)))) for k in range(120)]
    rows += [(500, None), (501, ""), (502, rows[7][1]), (502, rows[7][1]), (None, "secret=abcdefg"),
             (503, "token=abcdefgh " * 5000)]
    docs, path = documents(rows), staged_path(spark, "ledger-test")

    def scans():
        return spark.read.parquet(f"{path}/scans").count()

    S.create(spark, path)
    S.update(docs.filter("doc_id < 60"), path, S.BASE)
    before = scans()
    S.update(docs.filter("doc_id < 60"), path, S.BASE)
    assert scans() == before  # nothing unseen
    S.create(spark, path)     # keeps what is there
    S.update(docs, path, S.RULES)
    blobs = len({t or "" for _, t in rows})
    assert scans() == blobs * len(S.RULES)
    got = Counter((r.doc_id, tuple(tuple(s) for s in r.spans)) for r in S.by_path(docs, path).collect())
    assert got == Counter((i, tuple(brute_secrets(t))) for i, t in rows)
    newer = (S.Rule("assign", 2, S.BASE[0].pattern, 2, 8), *S.RULES[1:])
    S.update(docs, path, newer)
    assert scans() == blobs * (len(S.RULES) + 1)
    empty = documents([])
    S.update(empty, path)
    assert S.by_path(empty, path).count() == 0


@pytest.fixture(scope="module")
def word_bpe():
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    return path, Tokenizer.from_file(path), T.WordIds(path, "<u2")


def assert_encoded(word_bpe, texts):
    _, tokenizer, known = word_bpe
    ids, ends = known.documents(pa.array(texts, pa.string()))
    assert len(ends) == len(texts) and (len(ids) == ends[-1] if len(texts) else not len(ids))
    for text, a, b in zip(texts, [0, *ends.tolist()], ends.tolist()):
        assert ids[a:b].tolist() == tokenizer.encode(text, add_special_tokens=False).ids + [T.END], text


AWKWARD = ("aZ\u0130\u0131\u015f\u00e9\u00c9\u0301\u0307\u0327\u0345\u00df\u017f\u212a\u02bc'.,;:!?\u2019\u201c-019 \t\n\x0b\x1c\x85\u00a0\u4e2d\u65e5"
           "\u01c5\ufb01\u0391\u03a3\u0431\u042f\U0001d120<|>_")


@settings(max_examples=300, deadline=None, derandomize=True)
@given(st.lists(st.one_of(st.text(st.sampled_from(AWKWARD), max_size=40), st.text(max_size=20),
                          st.lists(st.sampled_from(["T\u00fcrk", "TAR\u0130H\u0130,", "<|endoftext|>", "a<|ENDOFTEXT|>b", "x\u0301;", "don't", "B.", "\u0130!"]),
                                   max_size=6).map(" ".join)), max_size=5))
def test_any_text_has_the_tokenizers_ids(word_bpe, texts):
    assert_encoded(word_bpe, texts)


def test_every_plain_letter_is_one_piece(word_bpe):
    letters = [chr(c) for c in range(0x80, 0x260)]
    assert_encoded(word_bpe, [f"{x}{x}, a{x}! {x}b" for x in letters])
    assert not T.plain_letters("TAR\u0130H") and not T.plain_letters("a1") and not T.plain_letters("")


def test_words_forgotten_and_met_again(word_bpe, monkeypatch):
    monkeypatch.setattr(T, "REMEMBERED", 30)
    monkeypatch.setattr(T, "GROUP_BYTES", 40)
    texts = pa.array([prose(k % 50, k % 7) for k in range(40)])
    sizes = [len(x) for x in T.groups(texts)]
    assert sum(sizes) == 40 and len(sizes) > 10
    for group in T.groups(texts):
        assert_encoded(word_bpe, group.to_pylist())


def repeated_rows():
    rng = random.Random(9)
    rows = [(k, prose(rng.randrange(0, 40), k), rng.choice("abcd")) for k in range(300)]
    rows += rng.choices(rows[:60], k=120) + [(77, "the same row of six words", "a")] * 90
    rows += [(78, f"{x} other words", "b") for x in "xyzxyzxy"] + [(None, None, None), (None, "", "a")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("together", [10_000, 7])
def test_placing_does_not_depend_on_the_splits(spark, documents, monkeypatch, together):
    """Sharding and mixing of repeated rows from 1, 2 and 7 partitions."""
    monkeypatch.setattr(C, "COPIES_TOGETHER", together)
    docs = documents(repeated_rows())
    found = []
    for parts in (1, 2, 7):
        dealt = docs.repartition(parts) if parts > 1 else docs.coalesce(1)
        found.append((Counter(map(tuple, H.sharded(dealt).collect())), Counter(map(tuple, X.mixed(dealt).collect())),
                      Counter((r.doc_id, r.text) for r in X.mixed_documents(dealt).collect())))
    assert found[0] == found[1] == found[2]
    assert found[0][0].total() == found[0][1].total() == docs.count()


def test_mixed_rows_give_what_the_mix_granted(documents):
    docs = documents(repeated_rows())
    granted, given = Counter(), Counter()
    for r in X.mixed(docs).collect():
        granted[r.doc_id, r.size] += -(-r.taken // max(1, r.size))
    for r in X.mixed_documents(docs).collect():
        given[r.doc_id, len(r.text.split())] += 1
    assert given == +granted


def brute_targets(sizes):
    names = sorted(sizes, key=lambda x: (x is None, (x or "").encode()))
    weights = {n: 1 + k % 3 for k, n in enumerate(names)}
    total, done = sum(sizes.values()), {}
    while True:
        left = total - sum(done.values())
        share = {n: left * weights[n] / sum(weights[m] for m in names if m not in done) for n in names if n not in done}
        over = {n: 3 * sizes[n] for n, s in share.items() if s > 3 * sizes[n] + 1e-9}
        if not over:
            return {**done, **share}, weights
        done.update(over)


def test_mix_comes_near_the_targets(documents):
    rng = random.Random(6)
    rows = [(k, prose(rng.randrange(0, 200), k), rng.choice(["b", "é", "Z", "a a", None])) for k in range(400)]
    rows += [(900, None, "b"), (901, "", "empty"), (None, prose(10), "a a"), (None, None, None)]
    rows += [(77, "the same row of six words", "hot")] * 300
    got = X.mixed(documents(rows)).collect()
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    targets, weights = brute_targets(sizes)
    taken = Counter()
    assert len(got) == len(rows)
    for r in got:
        name = None if r.unnamed else r.name
        assert (r.source_size, r.weight) == (sizes[name], weights[name])
        assert r.target == pytest.approx(targets[name])
        assert 0 <= r.taken <= 3 * r.size
        assert (r.shard is None) == (r.taken == 0)
        taken[name] += r.taken
    assert all(abs(taken[n] - targets[n]) <= X.BLOCK for n in sizes)
    again = X.mixed(documents(list(reversed(rows)))).collect()
    assert sorted((repr(r.doc_id), r.size, r.name, r.taken) for r in got) == \
        sorted((repr(r.doc_id), r.size, r.name, r.taken) for r in again)


def test_quotas_are_the_highest_quotients(spark):
    targets = {1: 5000.0, 2: 1234.5, 3: 333.0, 4: 12.0, 5: 0.0}
    total = 6580
    sources = spark.createDataFrame([(f"s{k}", False, k, total // 5, 1, t) for k, t in targets.items()],
                                    "name string, unnamed boolean, rank int, source_size long, weight int, target double")
    blocks = -(-total // X.BLOCK)
    order = sorted(((-t / (2 * s + 1), k) for k, t in targets.items() for s in range(blocks) if t))[:blocks]
    expected = Counter()
    for place, (_, k) in enumerate(order):
        expected[k, next(j for j in range(X.SHARDS) if place < blocks * (j + 1) // X.SHARDS)] += 1
    got = {(r["rank"], r["shard"]): r["blocks"] for r in X.quotas(sources).collect()}
    assert got == {(k, j): expected[k, j] for k in targets for j in range(X.SHARDS)}


def test_mixed_rows_are_whole_documents(documents):
    rows = [(k, prose(20 + k % 9, k), "big" if k % 10 else "small") for k in range(300)] + [(1000, None, None), (1001, "", "x")]
    docs = documents(rows)
    out = X.mixed_documents(docs)
    assert out.columns == docs.columns
    times = Counter((r.doc_id, r.text) for r in out.collect())
    taken = {r.doc_id: (r.taken, r.size) for r in X.mixed(docs).collect()}
    assert all(times[k, t] == -(-taken[k][0] // max(1, taken[k][1])) for k, t, _ in rows)
    assert max(times.values()) <= 3 and not times[1000, None]
    assert X.mixed_documents(documents([])).count() == 0 and X.mixed(documents([])).count() == 0
