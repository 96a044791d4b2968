"""Whitening: rank-one updates against a dense eigensolver, the query against plain numpy, odd vectors."""

from __future__ import annotations

import numpy as np
import pytest

from gridlake.llm.eigen_whitening import Spectrum, rank_one, whiten
from gridlake.llm.queries import QUERIES
from tests.conftest import SF_SMALL

RNG = np.random.default_rng(5)


@pytest.mark.parametrize(
    "rows",
    [
        RNG.integers(-40, 40, (300, 8)),
        RNG.integers(-40, 40, (5, 8)),  # fewer rows than dimensions
        np.repeat(RNG.integers(-40, 40, (3, 8)), 50, axis=0),  # equal rows
        np.hstack([RNG.integers(-40, 40, (200, 6)), np.full((200, 2), 7)]),  # constant dimensions
        np.full((20, 8), 3),
        RNG.integers(-40, 40, (100, 1)),
        np.vstack([np.eye(8), -np.eye(8)]) * 9,  # equal eigenvalues
    ],
)
def test_spectra(rows):
    rows = rows.astype(float)
    dim = rows.shape[1]
    parts = [Spectrum(dim) for _ in range(3)]
    for part, own in zip(parts, np.array_split(rows, 3)):
        for i in range(0, len(own), 7):
            part.add(own[i : i + 7])
    total = Spectrum.unpacked(parts[0].packed(), dim)
    for part in parts[1:]:
        total.merge(part)
    scatter = (rows - rows.mean(axis=0)).T @ (rows - rows.mean(axis=0))
    scale = max(np.abs(scatter).max(), 1.0)
    assert total.n == len(rows) and np.allclose(total.mean, rows.mean(axis=0))
    assert np.abs(total.q @ np.diag(total.d) @ total.q.T - scatter).max() <= 1e-12 * scale * len(rows)
    assert np.abs(total.q.T @ total.q - np.eye(dim)).max() < 1e-12


def test_rank_one_without_change():
    d, q = np.array([1.0, 2.0, 3.0]), np.eye(3)
    assert rank_one(d, q, np.zeros(3))[0] is d
    d2, q2 = rank_one(d, q, np.array([0.0, 2.0, 0.0]))
    assert np.allclose(d2, [1, 3, 6]) and np.allclose(np.abs(q2), [[1, 0, 0], [0, 0, 1], [0, 1, 0]])


def brute(vectors):
    """(n, deviation, eigenvalues, components, trace) by a dense eigensolver."""
    x = np.floor(64 * np.array(vectors, np.float64)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    e, u = np.linalg.eigh(np.cov((x - s / n).T, bias=True).reshape(x.shape[1], -1))
    far = [sum(int(v) ** 2 for v in row) for row in n * x.astype(object) - s]
    return x, n, s, far, e[::-1], u[:, ::-1]


def test_query_against_dense_solver(spark):
    given = {r.vec_id: r.embedding for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()}
    ids = list(given)
    x, n, s, far, e, u = brute([given[i] for i in ids])
    rows = QUERIES["op13_eigen_whitening"](spark, SF_SMALL).collect()
    assert len(rows) == 32 * n
    got = np.zeros((n, 32))
    place = {k: i for i, k in enumerate(ids)}
    for r in rows:
        got[place[r.vec_id], r.component - 1] = r.whitened
        assert r.n == n and r.deviation == far[place[r.vec_id]]
        assert r.identity_error <= 1e-9 and abs(r.explained / (e[r.component - 1] / e.sum()) - 1) < 1e-9
    want = ((x - s / n) @ u[:, :32]) / np.sqrt(e[:32])
    sign = np.sign((want * got).sum(axis=0))
    assert np.abs(want * sign - got).max() < 1e-7
    assert np.abs(got.T @ got / n - np.eye(32)).max() < 1e-9


def test_odd_vectors(spark):
    rows = [(1, [0.5, 1.0, -2.0]), (2, None), (3, [0.1, None, 1.0]), (4, [float("nan"), 1.0, 1.0]), (5, [float("inf"), 0.0, 0.0]), (6, []),
            (7, [1.0, 2.0]), (None, [0.25, 0.5, 3.0]), (8, [0.5, 1.0, -2.0]), (8, [0.5, 1.0, -2.0]), (9, [0.0, 4.0, 1.0])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, deviation string")
    out, model = whiten(df)
    got = [(r.id, r.deviation, r.whitened) for r in out.collect()]
    assert sorted((x[0] is None, x[0] or 0) for x in got) == [(False, 1), (False, 8), (False, 8), (False, 9), (True, 0)]
    x, n, s, far, e, u = brute([rows[i][1] for i in (0, 7, 8, 9, 10)])
    assert model["n"] == n == 5 and model["sums"] == s.tolist() and sorted(x[1] for x in got) == sorted(far)
    # five vectors, three of them equal, span two directions: the third component has no value
    assert e[2] < 1e-6 and all(x[2][2] is None and x[2][0] is not None for x in got)
    assert model["identity_error"] < 1e-9
    empty, none = whiten(df.filter("vec_id = 2"))
    assert empty.count() == 0 and none["n"] == 0
    same, flat = whiten(df.filter("vec_id = 8"))
    assert [r.whitened for r in same.collect()] == [[None] * 3] * 2 and flat["identity_error"] == 0


def test_large_counts_do_not_overflow(spark):
    df = spark.createDataFrame([(1, [1e30, 0.0]), (2, [-1e30, 0.0])], "vec_id long, embedding array<double>")
    out, _ = whiten(df)
    assert [r.deviation for r in out.collect()] == [None, None]
