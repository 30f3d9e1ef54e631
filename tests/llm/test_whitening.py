"""Embedding whitening against exact integers and a library's eigenvectors."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from jobtide.llm import whitening as W
from jobtide.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                       *(T.StructField(n, T.LongType()) for n in ("label", "n", "component", "part", "sums", "rows"))])


def table(spark, rows):
    return spark.createDataFrame([(i, v, 7, 7, 7, 7, 7, 7) for i, v in rows], SCHEMA)


def assert_decomposed(a):
    values, vectors = W.eigenpairs(a)
    expected = np.linalg.eigvalsh(a)[::-1]
    size = np.abs(expected).max()
    assert np.abs(values - expected).max() <= 1e-13 * size
    assert np.abs(vectors.T @ vectors - np.eye(len(a))).max() <= 1e-13
    assert np.abs(a @ vectors - vectors * values).max() <= 1e-13 * size


@settings(max_examples=150, deadline=None, derandomize=True)
@given(st.integers(1, 8), st.integers(0, 10 ** 6), st.sampled_from([1.0, 1e-9, 1e12]))
def test_small_matrices(d, seed, scale):
    b = np.random.default_rng(seed).integers(-2, 3, (d, d)) * 1.0
    a = scale * (b @ b.T)
    if a.any():
        assert_decomposed(a)


@pytest.mark.parametrize("kind", ["random", "multiple", "geometric", "rank one", "clustered", "diagonal", "negative"])
def test_hard_spectra(kind):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((200, 48))
    q, _ = np.linalg.qr(rng.standard_normal((48, 48)))
    spectrum = {"multiple": [1.0] * 20 + [2.0] * 25 + [3.0, 4.0, 5.0], "geometric": 2.0 ** -np.arange(48),
                "clustered": 1 + 1e-10 * np.arange(48), "negative": np.arange(48) - 20.0}
    assert_decomposed({"random": np.cov(x.T), "rank one": np.outer(x[0], x[0]), "diagonal": np.diag(np.arange(48.0))}[kind]
                      if kind not in spectrum else (m := (q * np.array(spectrum[kind])) @ q.T) / 2 + m.T / 2)


def test_polar_factor_is_orthogonal_and_its_projector_splits():
    rng = np.random.default_rng(5)
    a = rng.standard_normal((30, 30))
    a = a + a.T
    u = W.polar_factor(a)
    assert np.abs(u @ u.T - np.eye(30)).max() < 1e-12
    values, vectors = np.linalg.eigh(a)
    above = vectors[:, values > 0] @ vectors[:, values > 0].T
    assert np.abs((u + np.eye(30)) / 2 - above).max() < 1e-11


def brute(rows, k=W.COMPONENTS):
    """Exact integers, then a library's decomposition."""
    good = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    lengths = [len(v) for _, v in good]
    d = max(set(lengths), key=lambda n: (lengths.count(n), n))
    x = {j: [math.floor(1024 * float(np.float32(c))) + 100000 for c in v] for j, (_, v) in enumerate(good) if len(v) == d}
    n, sums = len(x), [sum(c) for c in zip(*x.values())]
    y = np.array([[float(n * a - s) / n for a, s in zip(v, sums)] for v in x.values()])
    values, vectors = np.linalg.eigh(y.T @ y / n)
    deviations = [sum((n * a - s) ** 2 for a, s in zip(v, sums)) for v in x.values()]
    return [good[j][0] for j in x], n, deviations, y, values[::-1][:k], vectors[:, ::-1][:, :k], values.sum()


def assert_whitened(got, rows):
    ids, n, deviations, y, values, vectors, trace = brute(rows)
    k = len(values)
    assert len(got) == len(ids) * k and {r.n for r in got} == {n}
    assert len({r.identity_error for r in got}) == 1
    expected = y @ vectors / np.sqrt(values)
    first = {}
    for j, i in enumerate(ids):
        first.setdefault(i, j)
    signs = {}
    for r in got:
        j, c = first[r.vec_id], r.component - 1
        assert r.deviation == deviations[j] or ids.count(r.vec_id) > 1
        assert r.explained == pytest.approx(values[c] / trace, rel=1e-9)
        if ids.count(r.vec_id) == 1 and abs(expected[j, c]) > 1e-3:
            sign = signs.setdefault(c, np.sign(r.whitened * expected[j, c]))
            assert r.whitened * sign == pytest.approx(expected[j, c], rel=1e-6, abs=1e-8)
    assert got[0].identity_error < 1e-9


def vectors(seed, n, d):
    rng = np.random.default_rng(seed)
    mixed = rng.standard_normal((n, d)) @ rng.standard_normal((d, d))
    return [(k, [float(c) for c in row]) for k, row in enumerate(mixed.astype(np.float32))]


def test_matches_brute_force_over_awkward_rows(spark):
    rows = vectors(1, 300, 10)
    rows += [(900, None), (901, []), (902, [1.0] * 9 + [None]), (903, [float("nan")] * 10), (904, [float("inf")] + [0.0] * 9),
             (905, [1.0, 2.0]), (906, [5.0] * 12), (None, [0.5] * 10), (3, rows[3][1]), (3, rows[3][1]), (907, [-0.0] * 10)]
    got = W.whiten(table(spark, rows)).collect()
    assert_whitened(got, rows)
    assert sum(r.vec_id == 3 for r in got) == 3 * 8 and sum(r.vec_id is None for r in got) == 8


def test_fit_does_not_depend_on_the_splits(spark):
    rows = vectors(2, 500, 6)
    models = [W.fit(W.fit_rows(table(spark, rows).repartition(parts))) for parts in (1, 2, 7)]
    for m in models[1:]:
        assert m.sums == models[0].sums and m.trace == models[0].trace
        assert (m.components == models[0].components).all() and (m.eigenvalues == models[0].eigenvalues).all()
    assert models[0].components.shape == (6, 6)


def test_equal_vectors_and_few_dimensions(spark):
    got = W.whiten(table(spark, [(k, [1.5, 2.5]) for k in range(4)])).collect()
    assert len(got) == 8
    assert {(r.deviation, r.whitened, r.explained, r.identity_error) for r in got} == {(0, 0.0, 0.0, 1.0)}
    line = W.whiten(table(spark, [(k, [1.0 * k, 2.0 * k]) for k in range(5)])).collect()
    assert {r.whitened for r in line if r.component == 2} == {0.0}
    assert sum(r.whitened ** 2 for r in line if r.component == 1) == pytest.approx(5)
    assert W.whiten(table(spark, [])).count() == 0
    assert W.whiten(table(spark, [(1, None)])).count() == 0


def test_entries_of_any_size(spark):
    rows = [(1, [3e30, 1.0]), (2, [-3e30, 2.0]), (3, [0.0, 3.0])]
    got = W.whiten(table(spark, rows)).collect()
    assert len(got) == 6 and {r.deviation for r in got if r.vec_id < 3} == {None}


def test_registered_query_over_the_whole_table(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert_whitened(QUERIES["op12_embedding_whitening"](spark, SF).collect(), rows)
