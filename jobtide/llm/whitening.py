"""Embedding whitening by QDWH spectral divide-and-conquer.

Entries become integers, x = floor(1024 * c) + 100000. Two passes give exact
sums: the sums of x, and those of the products of z = x less its rounded mean.
The z are small integers, so a task's matrix product in doubles is exact while
its entries stay under 2^53, and the covariance is the exact quotient, rounded
once: it does not depend on how the rows are dealt out. Beyond that size the
sums round as doubles do.

The covariance, dimension x dimension, is the only thing that the driver
decomposes, and MERGES partial matrices of that size are the most it receives. A shift s between its eigenvalues is chosen, the dynamically weighted
Halley iteration finds the orthogonal polar factor U of V - s I, and (U + I) / 2
projects on the invariant subspace of the eigenvalues above s. Bases of its
range and of its complement split V into two smaller matrices, which are split
again until each is a single component. The whitening map, dimension x
components, is broadcast with the task's code.

Defined results: rows whose vector is null or empty, or holds null or non-finite
entries, are dropped, and so are rows whose length is not that of most rows (of
lengths equally frequent, the largest counts). Repeated rows all count. Equal
eigenvalues have any orthonormal basis of their space, the same for all rows; a
component without variance, up to ROUNDING of the largest eigenvalue, is
whitened to 0. A deviation that exceeds a long is null. An empty table gives an
empty result. Other columns are ignored, but for those named in `carry`.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
MERGES = 16          # tasks that add up the partial sums, as many of which reach the driver
ROUNDING = 1e-13     # relative size below which an eigenvalue is rounding
SEED = 20            # of the random bases
MOST_STEPS = 200     # of the iteration; about 7 are needed
LONG = 2 ** 63 - 1


# ------------------------------------------------------------ decomposition

def polar_factor(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix, by the QDWH iteration.

    The weights follow a lower bound `low` of the smallest singular value; while
    they are large a step goes by QR, later by Cholesky.
    """
    n = len(a)
    x = a / np.linalg.norm(a)  # the Frobenius norm bounds the largest singular value
    eye = np.eye(n)
    low = np.finfo(float).eps / 4
    for _ in range(MOST_STEPS):
        d = np.cbrt(4 * (1 - low ** 2) / low ** 4)
        wa = np.sqrt(1 + d) + 0.5 * np.sqrt(max(0.0, 8 - 4 * d + 8 * (2 - low ** 2) / (low ** 2 * np.sqrt(1 + d))))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        if wc > 100:
            q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, eye]))
            y = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * q[:n] @ q[n:].T
        else:
            factor = np.linalg.cholesky(eye + wc * x.T @ x)
            half = np.linalg.solve(factor, x.T)
            y = wb / wc * x + (wa - wb / wc) * np.linalg.solve(factor.T, half).T
        y = (y + y.T) / 2
        low = min(1.0, low * (wa + wb * low ** 2) / (1 + wc * low ** 2))
        moved, x = np.linalg.norm(y - x), y
        if low > 1 - 1e-15 and moved <= 1e-14 * n:
            return x
        if low >= 1.0 and moved <= 1e-8:  # converges cubically: the next step is exact to rounding
            return 1.5 * x - 0.5 * x @ x.T @ x
    return x


def shifts(a: np.ndarray):
    """Places to split at: between the middle diagonal entries, at the mean eigenvalue, then
    places around it, which part the eigenvalues unless all are equal."""
    d = np.sort(np.diag(a))
    middle = len(d) // 2
    yield (d[middle - 1] + d[middle]) / 2
    mean, spread = d.mean(), np.linalg.norm(a - d.mean() * np.eye(len(a))) / np.sqrt(len(a))
    for step in (0.0, 0.1, -0.1, 0.2, -0.2, 0.3, -0.3, 0.4, -0.4, 0.6, -0.6, 0.8, -0.8):
        yield mean + step * spread


def split(a: np.ndarray, size: float, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Orthonormal bases of two invariant subspaces, that of the larger eigenvalues first."""
    n, best = len(a), None
    for shift in shifts(a):
        shifted = a - shift * np.eye(n)
        if not np.linalg.norm(shifted) > 0:
            continue
        above = (polar_factor(shifted) + np.eye(n)) / 2
        rank = int(round(np.trace(above)))
        if not 0 < rank < n:
            continue
        upper, _ = np.linalg.qr(above @ rng.standard_normal((n, rank)))
        upper, _ = np.linalg.qr(above @ upper)
        lower = rng.standard_normal((n, n - rank))
        for _ in range(2):
            lower, _ = np.linalg.qr(lower - upper @ (upper.T @ lower))
        error = np.linalg.norm(lower.T @ a @ upper)
        if best is None or error < best[0]:
            best = error, upper, lower
        if error <= 1e-15 * n * size:  # backward stable
            break
    if best is None:
        raise ArithmeticError("no shift parts the eigenvalues")
    return best[1], best[2]


def eigenpairs(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Falling eigenvalues and unit eigenvectors (columns) of a symmetric matrix."""
    rng, size = np.random.default_rng(SEED), np.linalg.norm(a)
    open_, values, vectors = [(a, np.eye(len(a)))], [], []
    while open_:
        part, basis = open_.pop()
        mean = np.trace(part) / len(part)
        if len(part) == 1 or np.linalg.norm(part - mean * np.eye(len(part))) <= 1e-16 * size:
            values += [mean] * len(part)
            vectors += list(basis.T)
            continue
        for q in split(part, size, rng):
            own = q.T @ part @ q
            open_.append(((own + own.T) / 2, basis @ q))
    q = np.array(vectors).T
    # Rounding of the many products is taken off: the basis is made orthonormal again and
    # each value is the quotient of its vector.
    order = np.argsort(-np.array(values), kind="stable")
    q, r = np.linalg.qr(q[:, order])
    q = q * np.sign(np.diag(r))
    values = np.einsum("ij,ij->j", q, a @ q)
    order = np.argsort(-values, kind="stable")
    return values[order], q[:, order]


# ---------------------------------------------------------------- exact sums

def usable(vector: str) -> Column:
    """Whether all entries are finite numbers; a null vector is not."""
    entry = lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != float("inf"))
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, entry), F.lit(False))


def fit_rows(vectors: DataFrame, vector: str = "embedding", carry: Sequence[str] = ()) -> DataFrame:
    """(__c, *carry): the remaining vectors as doubles, all of one length."""
    rows = vectors.select(F.col(vector).cast("array<double>").alias("__c"), *carry).filter(usable("__c"))
    most = rows.groupBy(F.size("__c").alias("n")).agg(F.count(F.lit(1)).alias("rows")) \
        .agg(F.max(F.struct("rows", "n")).alias("most")).first()["most"]
    return rows.filter(F.size("__c") == (most["n"] if most else 0))


def entries(batch: pa.RecordBatch) -> np.ndarray:
    """x of the first column, a row per vector, as doubles: whole numbers, exact to 2^53."""
    column = batch.column(0)
    if not len(column):
        return np.empty((0, 0))
    flat = np.asarray(column.flatten(), np.float64)
    return (np.floor(SCALE * flat) + OFFSET).reshape(len(column), -1)


def _summed(rows: DataFrame, partial) -> list[np.ndarray]:
    """`partial` of each batch's entries, summed within tasks, then by MERGES tasks."""
    def run(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                own = partial(entries(batch))
                total = own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    def merge(batches):
        total = None
        for batch in batches:
            for raw in batch.column(batch.schema.names.index("sums")):
                own = np.frombuffer(raw.as_py())
                total = own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    parts = rows.select("__c").mapInArrow(run, "sums binary").withColumn("part", F.spark_partition_id())
    merged = parts.repartition(MERGES, F.pmod("part", F.lit(MERGES))).sortWithinPartitions("part") \
        .mapInArrow(merge, "sums binary")
    return [np.frombuffer(bytes(r["sums"])) for r in merged.collect()]


class Whitening(NamedTuple):
    """What the fit list gives: counts, exact sums, components and their eigenvalues."""

    n: int
    sums: list[int]          # S, per dimension
    components: np.ndarray   # dimension x components
    eigenvalues: np.ndarray  # of the components
    trace: float
    identity_error: float

    @property
    def map(self) -> np.ndarray:
        """Projection on the components over the roots of their eigenvalues."""
        e = self.eigenvalues
        keeps = e > ROUNDING * max(e[0], 0.0) if len(e) else e > 0
        return self.components * np.where(keeps, 1 / np.sqrt(np.where(keeps, e, 1.0)), 0.0)


def covariance(n: int, sums: Sequence[int], products: Sequence[Sequence[int]]) -> np.ndarray:
    """(products / n) - means, exactly, each entry rounded once."""
    d = len(sums)
    v = np.empty((d, d))
    for i in range(d):
        for j in range(i + 1):
            v[i, j] = v[j, i] = float(Fraction(n * products[i][j] - sums[i] * sums[j], n * n))
    return v


def centred(x: np.ndarray, n: int, sums: Sequence[int]) -> np.ndarray:
    """x - S / n with an error of one rounding: whole mean first, then the rest of the division."""
    whole = np.array([s // n for s in sums], np.float64)
    rest = np.array([s % n / n for s in sums])
    return (x - whole) - rest


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Whitening of the rows of `fit_rows`; None without any."""
    first = [(int(p[0]), p[1:]) for p in _summed(rows, lambda x: np.concatenate(([len(x)], x.sum(axis=0))))]
    if not first:
        return None
    n, d = sum(k for k, _ in first), len(first[0][1])
    sums = [sum(int(s[j]) for _, s in first) for j in range(d)]
    base = np.array([(2 * s + n) // (2 * n) for s in sums], np.float64)

    def products(x):
        z = x - base
        return np.vstack([z.sum(axis=0), z.T @ z]).ravel()

    parts = [p.reshape(d + 1, d) for p in _summed(rows, products)]
    exact = [[sum(int(p[i, j]) for p in parts) for j in range(d)] for i in range(d + 1)]
    v = covariance(n, exact[0], exact[1:])
    values, vectors = eigenpairs(v) if np.any(v) else (np.zeros(d), np.eye(d))
    k = min(components, d)
    found = Whitening(n, sums, vectors[:, :k], np.maximum(values[:k], 0.0), float(np.trace(v)), 0.0)
    matrix = found.map

    def moments(x):
        w = centred(x, n, sums) @ matrix
        return np.vstack([w.sum(axis=0), w.T @ w]).ravel()

    seen = sum(_summed(rows, moments)).reshape(k + 1, k) / n
    error = np.abs(seen[1:] - np.outer(seen[0], seen[0]) - np.eye(k)).max()
    return found._replace(identity_error=float(error))


def whitened(rows: DataFrame, model: Whitening, key: str = "vec_id") -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error): a row per vector and component.

    `deviation` is the exact sum over the dimensions of (n * x - S)^2.
    """
    kind = rows.schema[key].dataType.simpleString()
    schema = (f"{key} {kind}, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double")
    names = [x.split()[0] for x in schema.split(", ")]
    n, sums, k, matrix = model.n, model.sums, len(model.eigenvalues), model.map
    means = np.array([s // n for s in sums], np.float64)
    rest = [s % n for s in sums]
    explained = model.eigenvalues / model.trace if model.trace > 0 else np.zeros(k)

    def deviations(x: np.ndarray) -> pa.Array:
        z = x - means
        most = n * (np.abs(z).max() + 1)
        if len(sums) * most * most < LONG:
            off = n * z.astype(np.int64) - np.array(rest, np.int64)
            return pa.array((off * off).sum(axis=1), pa.int64())
        exact = [sum((n * int(a) - b) ** 2 for a, b in zip(row, rest)) for row in z.tolist()]
        return pa.array([v if v <= LONG else None for v in exact], pa.int64())

    def run(batches):
        for batch in batches:
            x = entries(batch)
            if not len(x):
                continue
            w, count = centred(x, n, sums) @ matrix, len(x) * k
            each = np.repeat(np.arange(len(x)), k)
            yield pa.RecordBatch.from_arrays(
                [batch.column(1).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                 pa.array(np.full(count, n)), deviations(x).take(pa.array(each)), pa.array(w.ravel()),
                 pa.array(np.tile(explained, len(x))), pa.array(np.full(count, model.identity_error))], names=names)

    return rows.select("__c", key).mapInArrow(run, schema)


def whiten(vectors: DataFrame, components: int = COMPONENTS, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """Fit on all remaining rows of `vectors` and whiten them."""
    rows = fit_rows(vectors, vector, [key])
    model = fit(rows, components)
    if model is None:
        model = Whitening(1, [0], np.eye(1), np.zeros(1), 0.0, 0.0)
    return whitened(rows, model, key)
