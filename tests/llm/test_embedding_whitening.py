"""Embedding whitening against dense eigenvectors."""

import math

import numpy as np
import pytest

from wagelens.llm import embedding_whitening as ew

SCHEMA = "vec_id long, embedding array<double>, label int, n int"


def dense(vectors):
    """(n, per-dimension sums, covariance, eigenvalues and eigenvectors falling) by exact integers and numpy."""
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(col) for col in zip(*x)]
    centred = np.array([[(n * a - s) / n for a, s in zip(row, sums)] for row in x])
    e, u = np.linalg.eigh(centred.T @ centred / n)
    return n, sums, x, centred, e[::-1], u[:, ::-1]


def check(rows, vectors, k):
    n, sums, x, centred, e, u = dense(vectors)
    trace = e.sum()
    by = {}
    for r in rows:
        assert r.n == n and abs(r.explained / (e[r.component - 1] / trace) - 1) < 1e-9 and r.identity_error < 1e-8
        by.setdefault(r.vec_id, {})[r.component] = r
    assert len(by) == n and all(sorted(v) == list(range(1, k + 1)) for v in by.values())
    assert len({r.identity_error for r in rows}) == 1
    z = np.array([[by[i][c].whitened for c in range(1, k + 1)] for i in range(n)])
    for i in range(n):
        assert by[i][1].deviation == sum((n * a - s) ** 2 for a, s in zip(x[i], sums))
    expected = centred @ u[:, :k] / np.sqrt(e[:k])
    signs = np.sign((z * expected).sum(axis=0))
    assert np.abs(z * signs - expected).max() < 1e-7


@pytest.mark.parametrize("d", [5, 48, 200])
def test_components(spark, d):
    rng = np.random.default_rng(d)
    vectors = (rng.standard_normal((300, d)) * np.linspace(1, 4, d)).tolist()
    rows = [(i, v, 0, 1) for i, v in enumerate(vectors)]
    rows += [(9000, None, 0, 0), (9001, vectors[0][:-1] + [None], 0, 0), (9002, vectors[0][:-1] + [math.nan], 0, 0), (9003, [math.inf] + vectors[0][1:], 0, 0), (9004, [1.0], 0, 0), (9005, [], 0, 0)]
    got = ew.whiten(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    check(got, vectors, min(32, d))


def test_low_rank_repeated_rows_and_null_ids(spark):
    base = np.random.default_rng(1).standard_normal((6, 20))
    vectors = [base[i % 6].tolist() for i in range(40)]
    got = ew.whiten(spark.createDataFrame([(i, v, 0, 0) for i, v in enumerate(vectors)], SCHEMA)).collect()
    check(got, vectors, 5)
    nulls = ew.whiten(spark.createDataFrame([(None, v, 0, 0) for v in vectors], SCHEMA)).collect()
    assert len(nulls) == 40 * 5 and {r.vec_id for r in nulls} == {None}


def test_nothing_to_whiten(spark):
    for rows in ([], [(1, None, 0, 0)], [(1, [1.0, 2.0], 0, 0)], [(1, [1.0, 2.0], 0, 0)] * 4):
        out = ew.whiten(spark.createDataFrame(rows, SCHEMA))
        assert out.count() == 0 and out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_large_entries_are_exact(spark):
    vectors = [[1e12 * (i % 3), 5.0 * i, -1e12 * (i % 2)] for i in range(10)]
    got = ew.whiten(spark.createDataFrame([(i, v, 0, 0) for i, v in enumerate(vectors)], SCHEMA)).collect()
    n, sums, x, *_ = dense(vectors)
    for r in got:
        exact = sum((n * a - s) ** 2 for a, s in zip(x[r.vec_id], sums))
        assert r.deviation == (exact if exact < 2 ** 63 else None)
    assert {r.component for r in got} >= {1, 2} and all(math.isfinite(r.whitened) for r in got)


@pytest.mark.parametrize("values", [np.r_[np.full(40, 3.0), np.linspace(0, 2.9, 360)], np.linspace(1, 1.3, 400), 2.0 ** -np.arange(400)])
def test_clustered_and_close_eigenvalues(values):
    """Restarts, locking and corrections in a space much larger than the basis."""
    rng = np.random.default_rng(2)
    turn = np.linalg.qr(rng.standard_normal((400, 400)))[0]
    a = turn * values @ turn.T
    calls = []

    def product(q):
        calls.append(q.shape[1])
        return a @ q

    e, u = ew.jacobi_davidson(product, 400, 10, basis=40)
    assert np.abs(e - np.sort(values)[::-1][:10]).max() < 1e-10
    assert np.abs(u.T @ u - np.eye(10)).max() < 1e-12 and np.linalg.norm(a @ u - u * e, axis=0).max() < 1e-10
    assert max(calls) <= 40
