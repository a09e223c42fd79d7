"""Whitening against exact arithmetic in plain Python."""

import math
from fractions import Fraction

import numpy as np
import pytest

from haulback.llm import whitening

SCHEMA = "vec_id bigint, embedding array<float>, x string, n int, component string"


def table(spark, vectors, ids=None):
    ids = ids or range(len(vectors))
    return spark.createDataFrame([(i, v, "x", 1, "c") for i, v in zip(ids, vectors, strict=True)], SCHEMA).repartition(3)


def brute(vectors):
    """n, sums, covariance as fractions, x by row; over the distinct vectors."""
    x = [tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v) for v in vectors]
    fit = sorted(set(x))
    n, d = len(fit), len(fit[0])
    sums = [sum(v[i] for v in fit) for i in range(d)]
    centred = [[Fraction(v[i]) - Fraction(sums[i], n) for i in range(d)] for v in fit]
    covariance = [[sum(c[i] * c[j] for c in centred) / n for j in range(d)] for i in range(d)]
    return n, sums, covariance, x


def clouds(rng, n, d):
    base = rng.normal(size=(n, 5)) @ rng.normal(size=(5, d)) * 3 + rng.normal(size=(n, d)) * 0.3 + 7
    return [[float(np.float32(c)) for c in v] for v in base]


def test_against_fractions(spark):
    vectors = clouds(np.random.default_rng(3), 150, 20)
    vectors += vectors[:40] + [vectors[0]] * 30
    odd = [None, [], [1.0, None] + [0.0] * 18, [float("nan")] + [0.0] * 19, [float("inf")] + [0.0] * 19, [1.0, 2.0], [1.0, 2.0]]
    got = whitening.whiten(table(spark, vectors + odd)).collect()
    n, sums, covariance, x = brute(vectors)
    assert len(got) == 16 * len(vectors) and {r.n for r in got} == {n}
    exact = np.array([[float(c) for c in row] for row in covariance])
    values, axes = np.linalg.eigh(exact)
    values, axes = values[::-1], axes[:, ::-1]
    trace = float(sum(covariance[i][i] for i in range(20)))
    signs = {}
    for r in got:
        k = r.component - 1
        assert r.deviation == sum((n * a - s) ** 2 for a, s in zip(x[r.vec_id], sums, strict=True))
        assert r.explained == pytest.approx(values[k] / trace, rel=1e-6)
        z = sum(float(Fraction(a) - Fraction(s, n)) * e for a, s, e in zip(x[r.vec_id], sums, axes[:, k], strict=True)) / math.sqrt(values[k])
        assert abs(r.whitened) == pytest.approx(abs(z), abs=1e-6)
        if abs(z) > 1e-3:
            signs.setdefault(k, set()).add(math.copysign(1, z * r.whitened))
    assert all(len(s) == 1 for s in signs.values())
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-9


def test_square_sums_are_exact_at_any_size():
    for top in (50, 1 << 24, 1 << 40):
        y = np.random.default_rng(top).integers(-top, top, size=(300, 6))
        got = whitening.square_sums(y)
        for i in range(6):
            for j in range(i, 6):
                want = sum((int(r[i]) + (int(r[j]) if j > i else 0)) ** 2 for r in y)
                assert int(got[i, j]) == want


def test_polarisation_gives_the_covariances(spark):
    vectors = clouds(np.random.default_rng(5), 60, 4)
    found, d = whitening._of_usual_length(whitening.finite_vectors(table(spark, vectors), "embedding", ["vec_id"]))
    fit = whitening.fit_whitening(found.select("x").distinct(), d)
    _, _, covariance, _ = brute(vectors)
    back = fit.vectors @ np.diag(fit.values) @ fit.vectors.T
    assert np.allclose(back, [[float(c) for c in row] for row in covariance], rtol=1e-9, atol=1e-9)


def test_odd_tables(spark):
    empty = table(spark, [[1.0, 2.0]]).filter("1 = 0")
    assert whitening.whiten(empty).collect() == []
    assert whitening.whiten(empty).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert whitening.whiten(table(spark, [None, [], [None]])).collect() == []
    # one vector, many times: no variance, nothing to whiten
    same = whitening.whiten(table(spark, [[1.0, 2.0, 3.0]] * 5, [1, 1, None, 2, 3])).collect()
    assert len(same) == 15 and {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in same} == {(1, 0, None, 0.0, None)}
    # fewer dimensions than components, one of them constant
    flat = whitening.whiten(table(spark, [[float(k), 5.0] for k in range(8)])).collect()
    assert {(r.component, r.whitened is None) for r in flat} == {(1, False), (2, True)}
    assert flat[0].identity_error < 1e-12


def test_huge_entries_stay_exact(spark):
    vectors = [[float(2.0**k), float(-(2.0**k)), 1.0] for k in range(30, 46)] + [[3e38, -3e38, 0.0]]
    got = whitening.whiten(table(spark, vectors)).collect()
    top = 1 << 50
    x = [[max(-top, min(top, math.floor(64 * float(np.float32(c))))) + 1_000_000 for c in v] for v in vectors]
    n = len(set(map(tuple, x)))
    sums = [sum(c) for c in zip(*set(map(tuple, x)), strict=True)]
    assert {r.n for r in got} == {n}
    for r in got:
        want = sum((n * a - s) ** 2 for a, s in zip(x[r.vec_id], sums, strict=True))
        assert r.deviation == (want if want < 1 << 63 else None)
