"""Whitening against exact integers and NumPy's own eigenvectors, and on awkward rows."""

import math

import numpy as np
import pytest

from terraquilt.llm import queries, whitening

NAN, INF = float("nan"), float("inf")


@pytest.mark.parametrize("matrix", [
    np.diag([3.0, 3, 3, 1, 1, 0, 0, 0, 0]), np.zeros((9, 9)), np.ones((12, 12)), np.eye(20), np.array([[2.0]]),
    np.array([[1e-200, 0], [0, 3e-200]]), np.kron(np.eye(4), np.array([[2.0, 1], [1, 2]])),
    *[(lambda b: b @ b.T)(np.random.default_rng(n).normal(size=(n, n))) for n in (2, 5, 33, 120)],
])
def test_components_are_eigenvectors(matrix):
    k = min(8, len(matrix))
    values, found = whitening.leading_components(matrix, k)
    size = max(np.abs(matrix).max(), 1e-300)
    assert np.abs(values - np.linalg.eigvalsh(matrix)[::-1][:k]).max() <= 1e-13 * len(matrix) * size
    assert np.abs(found @ found.T - np.eye(k)).max() < 1e-12
    assert np.abs(matrix @ found.T - found.T * values).max() <= 1e-13 * len(matrix) * size


def test_sturm_counts_match_eigenvalues():
    rng = np.random.default_rng(4)
    d, e = rng.normal(size=30), rng.normal(size=29)
    e[7] = 0.0
    values = np.linalg.eigvalsh(np.diag(d) + np.diag(e, 1) + np.diag(e, -1))
    at = np.linspace(-4, 4, 101)
    assert whitening.counts_below(d, e, at).tolist() == [int((values < x).sum()) for x in at]


def brute(vectors, k=8):
    """x, exact deviations, and NumPy's whitening of the vectors up to signs."""
    x = [[math.floor(1024 * float(c)) + 100000 for c in v] for v in vectors]
    n, sums = len(x), [sum(column) for column in zip(*x)]
    deviations = [sum((n * a - s) ** 2 for a, s in zip(row, sums)) for row in x]
    y = np.array(x, float) - np.array([s / n for s in sums])
    cov = y.T @ y / n
    values, parts = np.linalg.eigh(cov)
    values, parts = values[::-1][:k], parts[:, ::-1][:, :k]
    return deviations, y @ parts / np.sqrt(values), values / np.trace(cov)


def check(rows, kept, k=8):
    deviations, want, explained = brute([v for _, v in kept], k)
    by = {}
    for r in rows:
        by.setdefault(r.vec_id, {})[r.component] = r
    assert set(by) == {i for i, _ in kept} and len(rows) == k * len(kept)
    got = np.array([[by[i][c].whitened for c in range(1, k + 1)] for i, _ in kept])
    assert np.abs(np.abs(got) - np.abs(want)).max() < 1e-7
    assert [int(by[i][1].deviation) for i, _ in kept] == deviations
    for r in rows:
        assert r.n == len(kept) and r.identity_error < 1e-9 and r.explained == pytest.approx(explained[r.component - 1], rel=1e-9)
    cov = (got - got.mean(axis=0)).T @ (got - got.mean(axis=0)) / len(got)
    assert np.abs(cov - np.eye(k)).max() < 1e-9


def test_whole_query_matches_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    kept = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    rows = queries.QUERIES["op11_embedding_whitening"](spark, sf_dir).collect()
    check(rows, kept)
    assert all(r.deviation == int(r.deviation_digits) for r in rows)


SCHEMA = "vec_id long, embedding array<float>, label int, key string, vector int, dim int, length int, i int, line double, n int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, None, "k", 1, 2, 3, 4, 5.0, 6) for i, v in rows], SCHEMA)


def test_unclean_vectors_repeats_and_other_lengths(spark):
    rng = np.random.default_rng(1)
    good = [(i, rng.normal(size=10).astype("float32").tolist()) for i in range(200)]
    good += [(1000 + i, good[0][1]) for i in range(120)]  # a third of all rows are one vector
    bad = [(3000, None), (3001, [None] * 10), (3002, [1.0] * 9 + [NAN]), (3003, [INF] + [0.0] * 9), (3004, [1.0] * 3), (3005, [])]
    df = table(spark, good + bad).repartition(7)
    fitted = whitening.fit_whitening(df)
    rows = whitening.whiten(df, fitted).collect()
    check(rows, good)
    twice = whitening.whiten(table(spark, [(None, good[3][1]), (None, good[3][1])]), fitted).collect()
    assert len(twice) == 16 and twice[0].vec_id is None
    near = whitening.fit_whitening(df.repartition(3))
    assert np.abs(near.components - fitted.components).max() < 1e-9


def test_empty_flat_and_wide_tables(spark):
    for df in (table(spark, []), table(spark, [(1, None), (2, []), (3, [NAN])])):
        assert whitening.fit_whitening(df) is None
        assert whitening.whiten(df, None).count() == 0
    same = table(spark, [(i, [0.5, 0.25]) for i in range(5)])
    rows = whitening.whiten(same, whitening.fit_whitening(same)).collect()
    assert len(rows) == 10 and all(r.whitened == 0 and r.identity_error == 1 and r.deviation == 0 and r.explained == 0 for r in rows)
    rng = np.random.default_rng(2)
    wide = [(i, (rng.normal(size=3) * 1e12).astype("float32").tolist()) for i in range(40)]
    df = table(spark, wide)
    check(whitening.whiten(df, whitening.fit_whitening(df)).collect(), wide, 3)
