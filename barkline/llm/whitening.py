"""Whitening of embeddings by eigenpairs from contour integration.

Entries become whole numbers, so sums over the distinct vectors (the fit list) are exact whatever the order
in which tasks add them: a first pass has their number and sums, a second one the products of what is
centred at the rounded mean. Only these d sums and d (d + 1) / 2 products reach the driver, where the
covariance follows from whole numbers and is rounded once.

``Feast`` finds the eigenpairs of the covariance within an interval: complex shifted solves (z I - V) X = Y at
the Gauss nodes of a circle through the interval's ends are added up to a projection onto the eigenvectors whose
values lie inside, Rayleigh-Ritz extracts them from the projected space, and both repeat until residuals are at
rounding level. Intervals come from inertia: a symmetric indefinite factorisation of V - s I counts the eigenvalues
above s, bisection puts the cuts into gaps, and an interval is done only if it gave as many pairs as the counts at
its ends differ by, so none is missed.

Whitening runs in Arrow batches. The identity error is measured: a pass over the fit list adds up the whitened
vectors' products.

Edge cases: vectors that are null or hold null or non-finite entries are dropped, as are entries beyond
the range of 64-bit integers and empty vectors; of vectors of several lengths those of the most frequent
one stay (the larger at a tie); repeated vectors count once in the fit and each gets its rows; components
without variance (rank deficiency, a single distinct vector, constant entries) can't be whitened and have no
rows; equal eigenvalues give some orthonormal basis of their space; an empty table gives an empty result; a deviation
beyond 64 bits is null; other columns than id and vector are dropped, whatever their names; a null id is kept.
"""

from __future__ import annotations

import decimal
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SEED, col, staged

#: An entry c becomes floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
#: Gauss nodes of a half circle, pairs of an interval at most where gaps allow it, and rounds of subspace iteration.
NODES, PAIRS, ROUNDS = 8, 8, 60

EPS = np.finfo(float).eps


def above(a: np.ndarray, shift: float) -> int:
    """How many eigenvalues of the symmetric ``a`` exceed ``shift``: the positive part of the inertia of a - shift I.

    The factorisation takes pivots of one or two rows with complete pivoting, so it is stable for indefinite matrices.
    """
    a = a - shift * np.eye(len(a))
    bound = (1 + 17**0.5) / 8
    count = 0
    while len(a):
        diagonal = np.abs(np.diag(a))
        off = np.abs(np.tril(a, -1))
        i, (p, q) = int(diagonal.argmax()), np.unravel_index(int(off.argmax()), off.shape)
        if max(diagonal[i], off[p, q]) == 0:
            break
        if diagonal[i] >= bound * off[p, q]:
            order = [i, *(k for k in range(len(a)) if k != i)]
            a = a[np.ix_(order, order)]
            count += a[0, 0] > 0
            a = a[1:, 1:] - np.outer(a[1:, 0], a[1:, 0]) / a[0, 0]
        else:
            # a pair whose determinant is negative: one value of each sign
            order = [p, q, *(k for k in range(len(a)) if k not in (p, q))]
            a = a[np.ix_(order, order)]
            count += 1
            a = a[2:, 2:] - a[2:, :2] @ np.linalg.solve(a[:2, :2], a[2:, :2].T)
        a = (a + a.T) / 2
    return int(count)


class Feast:
    """Eigenpairs of a symmetric matrix, interval by interval."""

    def __init__(self, v: np.ndarray, seed: int = SEED):
        self.v, self.scale = v, float(np.abs(v).sum(1).max())
        #: values nearer than this are one to the counts, by rounding
        self.least = 64 * len(v) * EPS * self.scale
        self.random = np.random.default_rng(seed)
        self.counts: dict[float, int] = {}

    def count(self, shift: float) -> int:
        if shift not in self.counts:
            self.counts[shift] = above(self.v, shift)
        return self.counts[shift]

    def centred(self, s: float, low: float, high: float) -> float:
        """A place near the middle of the gap in which ``s`` lies; quadrature tells values apart best far from its ends."""
        ends = []
        for far in (low, high):
            near = s
            for _ in range(8):
                m = (far + near) / 2
                far, near = (far, m) if self.count(m) == self.count(s) else (m, near)
            ends.append(near)
        return sum(ends) / 2

    def cuts(self, most: int) -> list[float]:
        """Falling borders: above the last one lie at least ``most`` eigenvalues; between two at most PAIRS where
        they can be told apart."""
        done = []
        high = self.scale * (1 + 1e-6)
        low = bottom = -high * 1e-6
        if self.count(low) > most:
            # the highest shift with enough values above it
            a, b = low, high
            while self.count(a) > most and b - a > 4 * self.least:
                m = (a + b) / 2
                a, b = (m, b) if self.count(m) >= most else (a, m)
            low = self.centred(max(a - self.least, bottom), bottom, high)
        todo = [(low, high)]
        while todo:
            a, b = todo.pop()
            inside = self.count(a) - self.count(b)
            if inside > PAIRS and b - a > 4 * self.least:
                m = self.centred((a + b) / 2, a, b)
                todo += [(a, m), (m, b)]
            elif inside:
                done.append((a, b))
        return sorted(done, reverse=True)

    def interval(self, a: float, b: float) -> tuple[np.ndarray, np.ndarray]:
        """(values, vectors) within [a, b), verified by the inertia counts."""
        n, want = len(self.v), self.count(a) - self.count(b)
        nodes, weights = np.polynomial.legendre.leggauss(NODES)
        middle, radius = (a + b) / 2, max((b - a) / 2, self.least)
        z = np.exp(1j * np.pi * (nodes + 1) / 2)  # the lower half follows by symmetry
        size = min(n, max(want + 4, 3 * want // 2))
        y = self.random.standard_normal((n, size))
        tolerance = 32 * n * EPS * self.scale
        for k in range(ROUNDS):
            q = np.zeros_like(y)
            for w, s in zip(weights, z, strict=True):
                q += w / 2 * np.real(radius * s * np.linalg.solve((middle + radius * s) * np.eye(n) - self.v, y))
            basis = np.linalg.qr(q)[0]
            basis = np.linalg.qr(basis)[0]
            small = basis.T @ self.v @ basis
            e, x = np.linalg.eigh((small + small.T) / 2)
            y = basis @ x
            inside = (e >= a) & (e < b)
            if inside.sum() == want:
                residual = np.abs(self.v @ y[:, inside] - y[:, inside] * e[inside]).max(initial=0)
                if residual <= tolerance:
                    return e[inside], y[:, inside]
            # a wider space holds the values just outside, which a circle damps least
            if size < n and (inside.sum() < want or k % 4 == 3):
                size = min(n, size + 4)
                y = np.concatenate([y, self.random.standard_normal((n, size - y.shape[1]))], 1)
        raise ArithmeticError(f"{want} eigenvalues lie in [{a}, {b}); contour integration did not find them")

    def largest(self, most: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``most`` largest eigenvalues, falling, and their vectors as columns; each vector's largest entry is positive."""
        if not self.scale:
            return np.zeros(0), np.zeros((len(self.v), 0))
        found = np.concatenate([self.interval(a, b)[1] for a, b in self.cuts(most)], 1)
        # once more over all intervals, so that near values on two sides of a cut are orthogonal too
        basis = np.linalg.qr(found)[0]
        small = basis.T @ self.v @ basis
        e, x = np.linalg.eigh((small + small.T) / 2)
        e, x = e[::-1][:most], (basis @ x[:, ::-1])[:, :most]
        return e, x * np.sign(x[np.abs(x).argmax(0), np.arange(x.shape[1])])


class Whitening:
    """Mean and components of a fit list."""

    def __init__(self, n: int, sums: list[int], products: list[list[int]], centre: list[int], components: int = COMPONENTS):
        """``products`` are those of x - ``centre``, summed over the list, as whole numbers."""
        self.n, self.sums, self.centre = n, sums, centre
        d = len(sums)
        rest = [s - n * c for s, c in zip(sums, centre, strict=True)]
        v = np.array([[float(Fraction(n * products[i][j] - rest[i] * rest[j], n * n)) for j in range(d)] for i in range(d)])
        e, x = Feast(v).largest(min(components, d))
        varied = e > d * EPS * e.max(initial=0)
        self.values, self.vectors = e[varied], x[:, varied]
        self.trace = float(np.trace(v))
        self.rest = np.array([float(Fraction(r, n)) for r in rest])  # of the mean, beyond the centre
        self.matrix = self.vectors / np.sqrt(self.values)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return ((x - np.array(self.centre, np.int64)) - self.rest) @ self.matrix

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Exact sums of (n x - S)^2."""
        z = x - np.array(self.centre, np.int64)
        rest = [s - self.n * c for s, c in zip(self.sums, self.centre, strict=True)]
        most = (np.abs(z).max(initial=0) * float(self.n) + max(map(abs, rest), default=0)) ** 2 * max(1, len(rest))
        if most < 2**62:
            return ((self.n * z - np.array(rest, np.int64)) ** 2).sum(1).tolist()
        exact = [sum((self.n * a - r) ** 2 for a, r in zip(row, rest, strict=True)) for row in z.tolist()]
        return [s if s < 1 << 63 else None for s in exact]


def _matrix(lists: pa.Array, d: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def integers(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, x): vectors as whole numbers, without those that can't be used."""
    raw = F.transform(col(vector), lambda c: F.floor(c.cast("double") * SCALE))
    good = F.forall(col(vector), lambda c: F.coalesce(F.abs(c.cast("double") * SCALE) < 2.0**62, F.lit(False)))
    good = F.coalesce(good, F.lit(False)) & (F.size(col(vector)) > 0)
    return rows.where(good).select(col(vec_id).alias("vec_id"), F.transform(raw, lambda c: c.cast("bigint") + SHIFT).alias("x"))


def fit(x: DataFrame, components: int = COMPONENTS) -> tuple[Whitening, DataFrame] | None:
    """The whitening of the distinct vectors of ``x`` and these; none if there is no vector."""
    length = x.groupBy(F.size("x").alias("d")).count().orderBy(F.col("count").desc(), F.col("d").desc()).first()
    if length is None:
        return None
    d = length["d"]
    distinct = staged(x.where(F.size("x") == d).select("x").distinct(), "fit")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * d
        for batch in batches:
            m = _matrix(batch.column(0), d)
            n += len(m)
            # halves, so that no sum overflows
            total = [t + (int(a) << 32) + int(b) for t, a, b in zip(total, (m >> 32).sum(0), (m & 0xFFFFFFFF).sum(0), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, d)), pa.array(map(decimal.Decimal, [n, *total]), pa.decimal128(38, 0))], names=["i", "s"])

    def gathered(f, *keys: str) -> dict:
        found = distinct.mapInArrow(f, ", ".join(f"{k} bigint" for k in keys) + ", s decimal(38,0)").groupBy(*keys).agg(F.sum("s").alias("s")).collect()
        return {tuple(r[k] for k in keys): r["s"] for r in found}

    first = gathered(sums, "i")
    n = int(first[-1,])
    total = [int(first[i,]) for i in range(d)]
    centre = [(2 * s + n) // (2 * n) for s in total]

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        added = np.zeros((d, d), object)
        for batch in batches:
            z = _matrix(batch.column(0), d) - np.array(centre, np.int64)
            if float(np.abs(z).max(initial=0)) ** 2 * len(z) < 2**53:
                z = z.astype(float)  # products and their sums are whole numbers below 2^53
                added += (z.T @ z).astype(np.int64)
            else:
                added += z.T.astype(object) @ z.astype(object)
        i, j = np.triu_indices(d)
        s = pa.array(map(decimal.Decimal, added[i, j].tolist()), pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), s], names=["i", "j", "s"])

    second = gathered(products, "i", "j")
    both = [[int(second[min(i, j), max(i, j)]) for j in range(d)] for i in range(d)]
    return Whitening(n, total, both, centre, components), distinct


def identity_error(model: Whitening, distinct: DataFrame) -> float:
    """The largest absolute entry of the whitened fit list's covariance minus the identity."""
    k, d = len(model.values), len(model.sums)
    sent = distinct.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        added = np.zeros((k + 1, k))
        for batch in batches:
            w = sent.value.whitened(_matrix(batch.column(0), d))
            added += np.concatenate([w.T @ w, w.sum(0)[None]])
        i, j = np.indices(added.shape)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel()), pa.array(j.ravel()), pa.array(added.ravel())], names=["i", "j", "s"])

    out = np.zeros((k + 1, k))
    for r in distinct.mapInArrow(run, "i bigint, j bigint, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect():
        out[r["i"], r["j"]] = r["s"]
    out /= model.n
    return float(np.abs(out[:k] - np.outer(out[k], out[k]) - np.eye(k)).max(initial=0))


def whiten(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """A row a vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    x = integers(rows, vec_id, vector)
    kind = x.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    found = fit(x, components)
    if found is None:
        return rows.sparkSession.createDataFrame([], schema)
    model, distinct = found
    error = identity_error(model, distinct)
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        k, d = len(model.values), len(model.sums)
        for batch in batches:
            m = _matrix(batch.column(1), d)
            rows = batch.num_rows
            each = np.repeat(np.arange(rows), k)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)), pa.array(np.full(rows * k, model.n)),
                pa.array(model.deviation(m), pa.int64()).take(pa.array(each)), pa.array(model.whitened(m).ravel()),
                pa.array(np.tile(model.values / model.trace if k else model.values, rows)), pa.array(np.full(rows * k, error)),
            ], names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return x.where(F.size("x") == len(model.sums)).mapInArrow(run, schema)
