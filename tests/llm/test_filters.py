"""Toxicity, decontamination, quality rules and classifier."""

import random
import re
import unicodedata
import zlib

import numpy as np
import pytest
from conftest_llm import prose
from pyspark.sql import functions as F

from jobtide.llm import decontamination as D
from jobtide.llm import line_quality as L
from jobtide.llm import quality_classifier as Q
from jobtide.llm import toxicity as T
from jobtide.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def sentence(rng, extra=()):
    words = [rng.choice(["river", "stone", "bread", "window", "garden", "letter", "table"]) for _ in range(7)]
    for word in extra:
        words.insert(rng.randrange(7), word)
    return " ".join(words) + "."


def toxic_corpus(n=300):
    """Documents of many sentences; a third holds one sentence with an insult."""
    rng, rows, marks = random.Random(1), [], []
    for k in range(n):
        bad = k % 3 == 0
        parts = [sentence(rng) for _ in range(rng.randrange(2, 30))]
        if bad:
            parts[rng.randrange(len(parts))] = sentence(rng, ["Blockhead" if k % 2 else "nitwit"])
        rows.append((k, " ".join(parts)))
        marks.append((k, 1, int(bad)))
    return rows, marks


def test_noisy_or_learns_the_insults_and_finds_the_sentence(spark, documents):
    rows, marks = toxic_corpus()
    edge = [(1000, None), (1001, ""), (1002, "..."), (1003, "nitwit"), (1003, "nitwit"), (None, "a blockhead here"),
            (1004, " ".join(["river stone."] * 20_000))]
    docs = documents(rows + edge)
    more = [(None, 1, 1), (5, 1, None), (2000, 1, 1)]
    model = T.fit(docs, labels_of(spark, marks + more))
    found = {(r.doc_id, r.text): r for r in T.scored(docs, model).join(docs.select("doc_id", "text"), "doc_id").collect()}
    texts = dict(rows)
    for doc_id, _, toxic in marks:
        row = found[doc_id, texts[doc_id]]
        assert (row.score >= T.REJECT) == bool(toxic)
        if toxic:
            assert [re.search("(?i)blockhead|nitwit", texts[doc_id][s.start:s.end]) is not None
                    for s in row.offending] == [True]
    assert found[1000, None].score == found[1001, ""].score == found[1002, "..."].score == 0
    assert found[1003, "nitwit"].score >= T.REJECT
    assert found[1004, edge[-1][1]].score < 0.05
    kept = T.clean_documents(docs, labels_of(spark, marks))
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {k for k, _, t in marks if not t} | {1000, 1001, 1002, 1004}


def test_held_out_labels_are_never_read(spark, documents):
    rows, marks = toxic_corpus(120)
    flipped = [(k, q, 1 - t if zlib.crc32(str(k).encode()) % 3 == 1 else t) for k, q, t in marks]
    docs = documents(rows)
    assert T.fit(docs, labels_of(spark, marks)) == T.fit(docs, labels_of(spark, flipped))


def test_a_repeated_id_gives_one_sample_row(spark, documents):
    ids = [k for k in range(60) if zlib.crc32(str(k).encode()) % 3 != 1][:20]
    docs = documents([(k, prose(9, k)) for k in ids] + [(ids[0], prose(9, 100 + k)) for k in range(40)])
    marks = labels_of(spark, [(k, 1, n % 2) for n, k in enumerate(ids)])
    sample = T.labelled_sample(docs, marks, "toxic").collect()
    assert sorted(r.label for r in sample) == [0] * 10 + [1] * 10
    assert sorted(r.positive for r in Q.samples(docs, marks).collect()) == [0] * 20 + [1] * 20


@pytest.mark.parametrize("marks", [[], [(1, 1, 1)], [(1, None, None)]])
def test_toxicity_without_both_labels(spark, documents, marks):
    docs = documents([(1, "a b c"), (None, None)])
    assert all(r.score < 0.01 for r in T.scored(docs, T.fit(docs, labels_of(spark, marks))).collect())
    empty = documents([])
    assert T.scored(empty, T.fit(empty, labels_of(spark, []))).count() == 0


def test_toxicity_on_held_out_rows(spark):
    """Held-out recall, false alarms and AUC. Some toxic rows of the given tables hold no word
    that any other toxic row holds (texts of one repeated word): no feature can find these."""
    found = QUERIES["op5_toxicity"](spark, "/root/testdata/sf0.1").filter("held_out")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = found.join(labels, "doc_id").select("score", "predicted", "toxic").collect()
    toxic, clean = ([r for r in rows if r.toxic == y] for y in (1, 0))
    a, b = (np.array([r.score for r in part]) for part in (toxic, clean))
    auc = ((a[:, None] > b).mean() + (a[:, None] == b).mean() / 2)
    recall, alarms = (np.mean([r.predicted for r in part]) for part in (toxic, clean))
    print(f"\nrecall {recall:.3f} of {len(a)}, false alarms {alarms:.4f} of {len(b)}, AUC {auc:.3f}")
    assert recall >= 0.87 and alarms <= 0.01 and auc >= 0.95
    evident = [r for r in toxic if r.score > 0]
    assert np.mean([r.predicted for r in evident]) >= 0.9


def brute_items(text, items, percent=80):
    def words(t):
        return re.findall(r"[^\W_]+", unicodedata.normalize("NFC", t or "").lower())

    def shingles(t, n):
        w = words(t)
        return {tuple(w[k:k + n]) for k in range(len(w) - n + 1)}

    found = []
    for i, t in items:
        n = min(5, len(words(t)))
        if n and 100 * len(shingles(t, n) & shingles(text, n)) >= percent * len(shingles(t, n)):
            found.append(i)
    return sorted(found)


def test_containment_matches_brute_force(spark, documents, monkeypatch):
    rng = random.Random(5)
    items = [(k, prose(rng.choice([3, 5, 9, 40, 60, 90, 300]), 100 + k)) for k in range(30)] + [(90, None), (91, "")]
    items += [(60, "one"), (61, "two words"), (62, "It\u2019s three words"), (63, "quatre mots \u00c9T\u00c9 c\u00f4t\u00e9"), (64, "... !"),
              (65, "Les \u00e9l\u00e8ves \u00abparlent\u00bb \u2014 souvent de la mer \u00c9T\u00c9")]
    rows = []
    for k in range(80):
        i, t = items[rng.randrange(30)]
        words = t.split()
        for _ in range(rng.randrange(0, 4)):
            words[rng.randrange(len(words))] = "changed"
        text = prose(rng.randrange(0, 900), k) + " " + " ".join(words).upper() + ", " + prose(50, 1000 + k)
        rows.append((k, text))
    rows += [(300, "this is ONE."), (301, "only two\nwords here; it's: three, words"), (302, "two  other words"),
             (303, "Quatre mots e\u0301te\u0301 \u201cc\u00d4t\u00e9\u201d fin"), (304, "\u2026les \u00c9L\u00c8VES parlent souvent de la mer e\u0301t\u00e9"),
             (305, "les eleves parlent souvent de la mer ete"), (306, "five words that no item holds")]
    rows += [(200, None), (201, ""), (200, None), (None, items[4][1]), (202, prose(30_000, 3) + "\n" + items[5][1])]
    table = spark.createDataFrame(items, "item_id long, text string")
    docs = documents(rows)
    expected = sorted((repr(i), brute_items(t, items)) for i, t in rows)
    for size in (D.BLOCK_SHINGLES, 400):  # one block of items, then many
        monkeypatch.setattr(D, "BLOCK_SHINGLES", size)
        got = D.with_matches(docs, table, carry=("doc_id",)).collect()
        assert sorted((repr(r.doc_id), sorted(m.item_id for m in r["__matches"])) for r in got) == expected
    kept = D.uncontaminated(docs, table)
    assert kept.columns == docs.columns
    assert sorted(repr(r.doc_id) for r in kept.collect()) == sorted(i for i, found in expected if not found)
    clash = docs.withColumn("__matches", F.lit("own"))
    assert {r["__matches"] for r in D.uncontaminated(clash, table).collect()} == {"own"}


def test_decontamination_of_empty_tables(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.uncontaminated(documents([(1, "a b c d e f")]), none).count() == 1
    assert D.uncontaminated(documents([]), none).count() == 0


def counts_of(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[k:k + 3]) for k in range(len(words) - 2)]
    repeated = {p for k, w in enumerate(windows) if windows.count(w) > 1 for p in (k, k + 1, k + 2)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)),
            len(repeated), len(words) < 50 or 100 * len(repeated) > 50 * len(words))


def test_base_counts_match_brute_force(documents):
    rng = random.Random(2)
    rows = [(k, "".join(rng.choice(["a ", "b ", "ß ", "𝄞", "\n", "x\t", "\x0b", " |", "#", " ", "a b c d e "])
                        for _ in range(rng.randrange(0, 120)))) for k in range(150)]
    rows += [(500, None), (501, ""), (502, " \n "), (503, "a a a a a"), (503, "a a a a a"), (None, prose(60)),
             (504, prose(30_000))]
    got = L.measured(documents(rows)).select("doc_id", "text", "__q.*").collect()
    for r in got:
        if r.doc_id != 504:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) \
                == counts_of(r.text), r.text
    assert len(got) == len(rows)
    assert L.measured(documents([])).count() == 0


def test_line_rules(documents):
    good = "\n".join(f"{prose(12, k)} ends well." for k in range(8))
    junk = "\n".join("home | news | sport | weather | more | about | help" for _ in range(3))
    rows = [(1, good), (2, good + "\nRead more here\n" + "*** ### $$$\n12345"),
            (3, "\n".join(f"a{k} | b{k} | c{k} | d{k} | e{k} | f{k} | g{k}" for k in range(20))),
            (4, "\n".join(f"{prose(9, k).upper().replace(' ', '!! ')}!!" for k in range(8))),
            (5, good + "\n" + junk), (6, None)]
    docs = documents(rows)
    kept = {r.doc_id: r.text for r in L.cleaned(docs).collect()}
    assert kept == {1: good, 2: good, 5: good}
    assert L.cleaned(docs).columns == docs.columns


def test_non_negative_risk_needs_no_negatives():
    rng = np.random.default_rng(0)
    good, bad = rng.normal(1.5, 1, (4000, 2)), rng.normal(-1.5, 1, (1500, 2))
    positive, unlabelled = good[:1500], np.vstack([good[1500:], bad])
    cuts = Q.quantile_cuts(unlabelled)
    p, u = Q.intervals(positive, cuts), Q.intervals(unlabelled, cuts)
    first = Q.non_negative_fit(p[:700], u[:2000], 0.5)
    prior = Q.estimated_prior(p[700:] @ first[:-1], u[2000:] @ first[:-1])
    weights = Q.non_negative_fit(p, u, 2500 / 4000)
    right = ((u @ weights[:-1] + weights[-1] > 0) == (np.arange(4000) < 2500)).mean()
    assert right > 0.95
    assert 0 < prior < 1


def test_quality_on_held_out_rows(spark):
    found = QUERIES["op9_quality_classifier"](spark, SF).filter("held_out")
    rows = found.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").select("score", "quality").collect()
    good, bad = [r.score for r in rows if r.quality], [r.score for r in rows if not r.quality]
    assert sum(g > b for g in good for b in bad) / (len(good) * len(bad)) > 0.95


def test_quality_edges(spark, documents):
    docs = documents([(1, None), (2, ""), (2, ""), (None, "some text."), (3, prose(30_000))])
    for marks in ([], [(2, 1, 0), (2, 0, 0), (None, 1, 0), (9, None, 0)]):
        scores = [r.score for r in Q.scored(docs, Q.fit(docs, labels_of(spark, marks))).collect()]
        assert scores == [0.5] * 5
    one = Q.fit(docs, labels_of(spark, [(3, 1, 0)]))
    assert all(0 <= r.score <= 1 for r in Q.scored(docs, one).collect())
    empty = documents([])
    assert Q.scored(empty, Q.fit(empty, labels_of(spark, [(1, 1, 0)]))).count() == 0
