"""Whitening against numpy's own eigenvectors of the exact covariance."""

from __future__ import annotations

import math

import numpy as np
import pytest

from yearbook.llm.whitening import Centred, bidiagonalise, quantised, whiten

COLUMNS = "vec_id bigint, embedding array<float>, label int, id string, x string, n double, component string"


def table(spark, vectors):
    rows = [(None if i == 2 else i, None if v is None else [None if c is None else float(c) for c in v], 1, "clash", "clash", 0.5, "clash") for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, COLUMNS)


def integers(vectors) -> list[list[int]]:
    good = [v for v in vectors if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    return [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for v in good]


def check(spark, vectors, components=32):
    x = integers(vectors)
    n, d = len(x), len(x[0])
    sums = [sum(r[j] for r in x) for j in range(d)]
    z = np.array([[n * r[j] - sums[j] for j in range(d)] for r in x], float) / n
    V = z.T @ z / n
    e, vectors_ = np.linalg.eigh(V)
    e, vectors_ = e[::-1], vectors_[:, ::-1]
    c = min(components, int((e > 1e-15 * max(e[0], 0)).sum()) if e[0] > 0 else 0)
    got = whiten(quantised(table(spark, vectors).repartition(3)), components).collect()
    assert len(got) == n * c
    if not c:
        return
    deviations = sorted(sum((n * r[j] - sums[j]) ** 2 for j in range(d)) for r in x)
    assert sorted(r.deviation for r in got if r.component == 1) == deviations and {r.n for r in got} == {n}
    for k in range(1, c + 1):
        mine = [r for r in got if r.component == k]
        assert mine[0].explained == pytest.approx(e[k - 1] / np.trace(V), rel=1e-9)
        gap = min([abs(e[k - 1] - e[j]) for j in range(d) if j != k - 1], default=e[0]) / e[0]
        if gap > 1e-4:
            want = z @ vectors_[:, k - 1] / math.sqrt(e[k - 1])
            have = np.array(sorted(r.whitened for r in mine))
            assert min(np.abs(have - np.sort(s * want)).max() for s in (1, -1)) < 1e-8
    errors = {r.identity_error for r in got}
    assert len(errors) == 1 and errors.pop() < 1e-9


def test_random_vectors_with_awkward_rows(spark):
    rng = np.random.default_rng(1)
    good = (rng.standard_normal((300, 10)) * np.linspace(0.1, 2, 10)).tolist()
    bad = [None, [None] * 10, [float("nan")] + [0.0] * 9, [float("inf")] + [0.0] * 9, [*good[0][:9], None]]
    check(spark, [*good[:5], *bad, *good[5:], *good[:20]])
    check(spark, good[:40], components=3)


def test_rank_ties_and_constants(spark):
    rng = np.random.default_rng(2)
    base = rng.integers(-3, 4, (200, 3))
    check(spark, np.column_stack([base, base[:, 0] + base[:, 1], np.full(200, 7)]).tolist())  # rank 3 of 5
    square = [[s * (i == j) for j in range(4)] for i in range(4) for s in (-1.0, 1.0)]  # four equal eigenvalues
    check(spark, square)
    check(spark, [[1.0, 2.0]] * 5)  # no spread: no component
    check(spark, [[1.0, 2.0], [3.0, 5.0]])  # fewer vectors than dimensions
    check(spark, [[float(i)] for i in range(7)])


def test_settles_before_the_whole_dimension(spark):
    rng = np.random.default_rng(3)
    basis, _ = np.linalg.qr(rng.standard_normal((60, 60)))
    vectors = (rng.standard_normal((400, 60)) * (200 * 0.6 ** np.arange(60) + 0.001)) @ basis
    x = Centred(quantised(table(spark, vectors.tolist())), "vec_id")
    calls, summed = [], x.summed
    x.summed = lambda of, size: calls.append(size) or summed(of, size)
    values, directions = bidiagonalise(x, 4)
    z = np.array(integers(vectors.tolist()), float)
    want = np.linalg.svd(z - z.mean(axis=0), compute_uv=False)[:4]
    assert np.allclose(values, want, rtol=1e-10) and np.allclose(directions.T @ directions, np.eye(4), atol=1e-12) and len(calls) < 50


def test_no_vectors_and_odd_lengths(spark):
    for vectors in ([], [None, None], [[]]):
        assert whiten(quantised(table(spark, vectors))).collect() == []
    got = whiten(quantised(table(spark, [[1.0, 2.0], [3.0, 5.0], [4.0, 4.0], [1.0], [1.0, 2.0, 3.0], []]))).collect()
    assert {r.vec_id for r in got} == {0, 1, None} and {r.n for r in got} == {3}
