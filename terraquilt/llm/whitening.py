"""Embedding whitening: distributed centred covariance, leading eigenvectors by Householder, Sturm counts and inverse iteration."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: An entry c counts as floor(1024 * c) + 100000, held within 62 bits.
_SCALE, _SHIFT, _WIDEST = 1024.0, 100_000, 2.0**62
_EPS = np.finfo(float).eps


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and the Householder vectors that bring a symmetric matrix to them, first one first."""
    a = np.array(matrix, float)
    n = len(a)
    off = np.zeros(max(0, n - 1))
    vectors = []
    for k in range(n - 1):
        x = a[k + 1:, k]
        length = float(np.linalg.norm(x))
        target = -np.copysign(length, x[0])
        v = x.copy()
        v[0] -= target
        size = float(np.linalg.norm(v))
        off[k] = target if size else 0.0
        v = v / size if size else v
        vectors.append(v)
        rest = a[k + 1:, k + 1:]
        p = rest @ v
        w = p - (v @ p) * v
        rest -= 2.0 * (np.outer(v, w) + np.outer(w, v))
    return np.diag(a).copy(), off, vectors


def counts_below(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sturm counts: how many eigenvalues of the tridiagonal matrix are below each of the values."""
    tiny = _EPS * max(1.0, float(np.max(off**2, initial=0.0)))
    found = np.zeros(len(values), int)
    taken = np.zeros(len(values))
    for d, e in zip(diagonal, [*off, 0.0]):
        q = d - values - taken
        q = np.where(np.abs(q) < tiny, -tiny, q)
        found += q < 0
        taken = e * e / q
    return found


def leading_eigenvalues(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The k greatest eigenvalues, falling, each bisected until no double lies between its bounds."""
    n = len(diagonal)
    reach = np.abs(np.concatenate([off, [0.0]])) + np.abs(np.concatenate([[0.0], off]))
    margin = 4 * _EPS * float(np.max(np.abs(diagonal) + reach))
    low = np.full(k, float(np.min(diagonal - reach)) - margin)
    high = np.full(k, float(np.max(diagonal + reach)) + margin)
    below = n - 1 - np.arange(k)  # eigenvalues beneath the one sought
    while True:
        middle = low + (high - low) / 2
        open_ = (middle > low) & (middle < high)
        if not open_.any():
            return np.sort(middle)[::-1]
        above = counts_below(diagonal, off, middle) > below
        high = np.where(open_ & above, middle, high)
        low = np.where(open_ & ~above, middle, low)


def _solver(diagonal: np.ndarray, off: np.ndarray, shift: float, floor: float) -> Callable[[np.ndarray], np.ndarray]:
    """Solves (T - shift) z = b by elimination with row exchanges; a pivot that vanishes counts as ``floor``."""
    n = len(diagonal)
    rows = []  # pivot, next, one after, factor, exchanged
    top = [float(diagonal[0] - shift), float(off[0]) if n > 1 else 0.0, 0.0]
    for i in range(n - 1):
        under = [float(off[i]), float(diagonal[i + 1] - shift), float(off[i + 1]) if i + 2 < n else 0.0]
        exchanged = abs(under[0]) > abs(top[0])
        if exchanged:
            top, under = under, top
        pivot = top[0] if abs(top[0]) >= floor else np.copysign(floor, top[0])
        factor = under[0] / pivot
        rows.append((pivot, top[1], top[2], factor, exchanged))
        top = [under[1] - factor * top[1], under[2] - factor * top[2], 0.0]
    last = top[0] if abs(top[0]) >= floor else np.copysign(floor, top[0])

    def solve(b: np.ndarray) -> np.ndarray:
        z = b.astype(float).tolist()
        for i, (_, _, _, factor, exchanged) in enumerate(rows):
            if exchanged:
                z[i], z[i + 1] = z[i + 1], z[i]
            z[i + 1] -= factor * z[i]
        z[-1] /= last
        for i in range(n - 2, -1, -1):
            pivot, one, two, _, _ = rows[i]
            z[i] = (z[i] - one * z[i + 1] - (two * z[i + 2] if i + 2 < n else 0.0)) / pivot
        return np.array(z)

    return solve


def inverse_iteration(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray, rounds: int = 6) -> np.ndarray:
    """Unit eigenvectors (rows) of the tridiagonal matrix for its falling eigenvalues.

    Each starts from seeded noise. Vectors of a cluster, values nearer to each other than a
    thousandth of the matrix, are made orthogonal to those before them in every round, and
    equal values are moved apart by a few last digits first.
    """
    n = len(diagonal)
    norm = max(float(np.max(np.abs(diagonal))) + 2 * float(np.max(np.abs(off), initial=0.0)), _EPS)
    noise = np.random.default_rng(7)
    found = np.zeros((len(values), n))
    first, shift = 0, np.inf
    for i, value in enumerate(values):
        if i and values[i - 1] - value > 1e-3 * norm:
            first = i
        shift = min(float(value), shift - 10 * _EPS * norm) if i > first else float(value)
        solve = _solver(diagonal, off, shift, _EPS * norm)
        z = noise.uniform(-1, 1, n)
        for _ in range(rounds):
            z = solve(z / np.max(np.abs(z)))
            z /= np.max(np.abs(z))
            for _ in range(2):
                z -= found[first:i].T @ (found[first:i] @ z)
            z /= np.linalg.norm(z)
        found[i] = z
    return found


def leading_components(covariance: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k greatest eigenvalues, falling, and their unit eigenvectors as rows, each with its greatest entry positive."""
    scale = float(np.max(np.abs(covariance), initial=0.0)) or 1.0
    diagonal, off, vectors = tridiagonal(covariance / scale)
    values = leading_eigenvalues(diagonal, off, k)
    found = inverse_iteration(diagonal, off, values)
    for i in range(len(vectors) - 1, -1, -1):
        tail = found[:, i + 1:]
        tail -= 2.0 * np.outer(tail @ vectors[i], vectors[i])
    found /= np.linalg.norm(found, axis=1, keepdims=True)
    signs = np.sign(found[np.arange(k), np.argmax(np.abs(found), axis=1)])
    return np.maximum(values, 0.0) * scale, found * signs[:, None]


@dataclass(frozen=True)
class Whitening:
    """What one pass over all vectors learns: their number, exact sums, components, variances and their share."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray  # k x dimensions
    variances: np.ndarray
    explained: np.ndarray
    identity_error: float = float("nan")

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n, the whole part of S/n taken off as integers."""
        whole = np.array([s // self.n for s in self.sums])
        part = np.array([s % self.n / self.n for s in self.sums])
        return (x - whole).astype(float) - part

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """Coordinates of unit variance; 0 along a component without variance."""
        dead = self.variances <= len(self.sums) * _EPS * max(float(self.variances[0]), np.finfo(float).tiny)
        scales = np.where(dead, 0.0, 1.0 / np.sqrt(np.where(dead, 1.0, self.variances)))
        return self.centred(x) @ self.components.T * scales

    def deviations(self, x: np.ndarray) -> list[int]:
        """Exact sums over the dimensions of (n x - S)^2: with y = x - S//n and r = S mod n, of (n y - r)^2."""
        y = x - np.array([s // self.n for s in self.sums])
        r = np.array([s % self.n for s in self.sums])
        widest = max(int(np.max(np.abs(y), initial=0)), 1)
        if widest * max(widest, self.n) * len(self.sums) >= 2**62:
            y, r = y.astype(object), r.astype(object)
        squares, products = (y * y).sum(axis=1).tolist(), (y * r).sum(axis=1).tolist()
        rest = sum(s % self.n * (s % self.n) for s in self.sums)
        return [self.n * self.n * a - 2 * self.n * b + rest for a, b in zip(squares, products)]


def _entries(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, pa.Array]:
    """Rows of the batch whose vector has no null and no non-finite entry, and the vectors themselves."""
    vectors = batch.column(name)
    lengths = np.diff(vectors.offsets.to_numpy())
    flat = pa.array(vectors.flatten()).cast(pa.float64()).to_numpy(zero_copy_only=False)  # a null entry is NaN
    valid = vectors.is_valid().to_numpy(zero_copy_only=False)
    lengths = np.where(valid, lengths, 0)
    rows = np.repeat(np.arange(len(lengths)), lengths)
    bad = np.bincount(rows[~np.isfinite(flat)], minlength=len(lengths))
    good = np.flatnonzero(valid & (bad == 0))
    return good, vectors


def _whole_numbers(vectors: pa.Array) -> np.ndarray:
    """floor(1024 c) + 100000 of vectors of one length, as a matrix of longs."""
    flat = pa.array(vectors.flatten()).cast(pa.float64()).to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore"):
        whole = np.clip(np.floor(flat * _SCALE), -_WIDEST, _WIDEST)
    return whole.astype(np.int64).reshape(len(vectors), -1) + _SHIFT


def _by_length(batch: pa.RecordBatch, name: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Length, rows and whole numbers of the batch's clean vectors, one length at a time."""
    good, vectors = _entries(batch, name)
    kept = vectors.take(pa.array(good, pa.int64()))
    lengths = np.diff(kept.offsets.to_numpy())
    for length in np.unique(lengths[lengths > 0]).tolist():
        at = np.flatnonzero(lengths == length)
        yield length, good[at], _whole_numbers(kept.take(pa.array(at, pa.int64()))).reshape(len(at), length)


def _sums(vectors: DataFrame) -> tuple[int, int, tuple[int, ...]]:
    """Length, number and exact sums of the vectors of the most frequent length (the greater of equally frequent ones)."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, tuple[int, np.ndarray]] = {}
        for batch in batches:
            for length, rows, x in _by_length(batch, "vector"):
                n, total = known.get(length, (0, np.zeros(length, object)))
                high, low = (x >> 32).sum(axis=0).astype(object), (x & 0xFFFFFFFF).sum(axis=0).astype(object)
                known[length] = n + len(rows), total + (high * 2**32 + low)
        for length, (n, total) in known.items():
            dims = range(-1, length)
            yield pa.RecordBatch.from_pydict({
                "length": pa.array([length] * len(dims), pa.int32()), "dim": pa.array(dims, pa.int32()),
                "total": pa.array([Decimal(n), *map(Decimal, total)], pa.decimal128(38, 0)),
            })

    parts = vectors.mapInArrow(add, "length int, dim int, total decimal(38,0)")
    whole = parts.groupBy("length", "dim").agg(F.sum("total").cast("decimal(38,0)").alias("total"))
    longest = parts.where(F.col("dim") == -1).groupBy("length").agg(F.sum("total").alias("n")).orderBy(
        F.col("n").desc(), F.col("length").desc()
    ).first()
    if longest is None:
        return 0, 0, ()
    rows = whole.where((F.col("length") == longest["length"]) & (F.col("dim") >= 0)).orderBy("dim").collect()  # one a dimension
    return longest["length"], int(longest["n"]), tuple(int(r["total"]) for r in rows)


def _products(vectors: DataFrame, length: int, centred: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over all vectors of the outer product of what ``centred`` makes of them.

    A task adds up its vectors and sends one row for each row of its matrix; these are added by
    their number, so a matrix of d rows is summed in d groups, each a running sum.
    """
    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for size, _, x in _by_length(batch, "vector"):
                if size == length:
                    values = centred(x)
                    total = values.T @ values if total is None else total + values.T @ values
        if total is not None:
            yield pa.RecordBatch.from_pydict({
                "i": pa.array(range(len(total)), pa.int32()), "line": pa.array(list(total), pa.list_(pa.float64())),
            })

    def add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0.0
        for batch in batches:
            lines = batch.column("line")
            total = total + pa.array(lines.flatten()).to_numpy().reshape(len(lines), -1).sum(axis=0)
        yield pa.RecordBatch.from_pydict({"i": pa.array([key[0].as_py()], pa.int32()), "line": pa.array([total], pa.list_(pa.float64()))})

    lines = vectors.mapInArrow(multiply, "i int, line array<double>").groupBy("i").applyInArrow(add, "i int, line array<double>")
    return np.array([r["line"] for r in sorted(lines.collect(), key=lambda r: r["i"])])  # dimensions squared


def fit_whitening(table: DataFrame, components: int = 8, vector: str = "embedding") -> Whitening | None:
    """Components of all clean vectors of ``table``; None if there are none with entries.

    Clean are vectors that aren't NULL and hold no NULL, NaN or infinite entry. Those of the most
    frequent length count; others are left out like unclean ones. Entries are the whole numbers
    x = floor(1024 c) + 100000. Two passes: exact sums, then products of x - S/n; a third one
    measures the covariance of the whitened vectors. Only sums and matrices of the dimension
    reach the driver. A component without variance is whitened to 0, and identity_error is 1 then.
    """
    vectors = table.select(F.col(vector).alias("vector"))
    length, n, sums = _sums(vectors)
    if not length:
        return None
    k = min(components, length)
    start = Whitening(n, sums, np.zeros((k, length)), np.zeros(k), np.zeros(k))
    covariance = _products(vectors, length, start.centred) / n
    values, found = leading_components((covariance + covariance.T) / 2, k)
    trace = float(np.trace(covariance))
    fitted = Whitening(n, sums, found, values, values / trace if trace > 0 else np.zeros(k))
    shared = table.sparkSession.sparkContext.broadcast(fitted)
    error = _products(vectors, length, lambda x: shared.value.whitened(x)) / n - np.eye(k)
    shared.destroy()
    return Whitening(n, sums, found, values, fitted.explained, float(np.max(np.abs(error))))


def whiten(table: DataFrame, fitted: Whitening | None, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """For each clean row and component: key, component (from 1), n, deviation (decimal), whitened, explained, identity_error.

    The fitted projection is broadcast; no shuffle. Rows are kept as they come: a NULL or repeated
    key, and repeated vectors, each have rows of their own. Unclean vectors and those of another
    length than the fitted ones have none, and without a fit there are no rows. A deviation
    of more than 38 digits is NULL. Other columns are left out.
    """
    kind = table.schema[key].dataType.simpleString()
    schema = f"key {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    shared = table.sparkSession.sparkContext.broadcast(fitted)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches if model else ():
            for length, rows, x in _by_length(batch, "vector"):
                if length != len(model.sums):
                    continue
                k = len(model.variances)
                deviations = [Decimal(v) if v < 10**38 else None for v in model.deviations(x)]
                each = pa.array(np.repeat(np.arange(len(rows)), k))
                count = len(rows) * k
                yield pa.RecordBatch.from_pydict({
                    "key": batch.column("key").take(pa.array(np.repeat(rows, k))),
                    "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
                    "n": pa.array(np.full(count, model.n)),
                    "deviation": pa.array(deviations, pa.decimal128(38, 0)).take(each),
                    "whitened": pa.array(model.whitened(x).reshape(-1)),
                    "explained": pa.array(np.tile(model.explained, len(rows))),
                    "identity_error": pa.array(np.full(count, model.identity_error)),
                })

    rows = table.select(F.col(key).alias("key"), F.col(vector).alias("vector"))
    return rows.mapInArrow(project, schema).withColumnRenamed("key", key)
