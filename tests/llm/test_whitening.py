"""Whitening against numpy's dense eigenvectors."""

import math

import numpy as np
import pytest

from tailloom.llm import whitening


def naive(rows, components):
    """(id, component) to (n, deviation, |whitened|), explained by component, of complete vectors."""
    whole = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    xs = [[math.floor(64 * c) + 1_000_000 for c in v] for _, v in whole]
    listed = sorted({tuple(x) for x in xs})
    n, sums = len(listed), [sum(c) for c in zip(*listed)]
    y = np.array([[(n * c - s) / n for c, s in zip(x, sums)] for x in listed])
    values, vectors = np.linalg.eigh(y.T @ y / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(components, int((values > 1e-9 * values.sum()).sum()))
    onto = vectors[:, :k] / np.sqrt(values[:k])
    out = {}
    for (i, _), x in zip(whole, xs):
        w = np.array([(n * c - s) / n for c, s in zip(x, sums)]) @ onto
        for j in range(k):
            out.setdefault((i, j + 1), []).append((n, sum((n * c - s) ** 2 for c, s in zip(x, sums)), abs(w[j])))
    return out, values / values.sum()


def check(df, rows, components):
    want, explained = naive(rows, components)
    got = {}
    for r in df.collect():
        got.setdefault((r.vec_id, r.component), []).append((r.n, int(r.deviation), abs(r.whitened)))
        assert r.identity_error <= 1e-10 and abs(r.explained / explained[r.component - 1] - 1) < 1e-10
    assert got.keys() == want.keys()
    for key, found in got.items():
        for one, other in zip(sorted(found), sorted(want[key])):
            assert one[:2] == other[:2] and abs(one[2] - other[2]) < 1e-6


def vectors(n, d, seed=0, scale=1.0):
    rng = np.random.default_rng(seed)
    return (rng.standard_normal((n, d)) * np.linspace(1, 2, d) * scale).astype(np.float32).tolist()


SCHEMA = "vec_id long, embedding array<float>, x string, component int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "c", 0) for i, v in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("d,components", [(24, 6), (3, 16), (1, 2)])
def test_whitening(spark, d, components):
    rows = list(enumerate(vectors(200, d)))
    rows += rows[:20] + [(None, rows[5][1]), (900, rows[7][1])]  # copies, one without an id
    bad = [(1000, None), (1001, [None] * d), (1002, [math.nan] * d), (1003, [math.inf] * d), (1004, []), (1005, [1.0] * (d + 1))]
    check(whitening.whiten(frame(spark, rows + bad), components=components), rows, components)


def test_without_variance(spark):
    """No rows, one vector, equal vectors: nothing; vectors on a line: one component."""
    rows = list(enumerate(vectors(30, 4)))
    assert whitening.whiten(frame(spark, rows).limit(0)).count() == 0
    assert whitening.whiten(frame(spark, [(i, rows[0][1]) for i in range(5)])).count() == 0
    line = [(i, [float(i), 2.0 * i, -1.0 * i]) for i in range(40)]
    check(whitening.whiten(frame(spark, line)), line, 16)


def test_large_values_are_exact(spark):
    rows = list(enumerate(vectors(50, 3, scale=1e8)))
    check(whitening.whiten(frame(spark, rows)), rows, 16)


@pytest.mark.parametrize("d,k,space", [(300, 8, 24), (120, 16, 40), (60, 5, 12)])
@pytest.mark.parametrize("kind", ["wide", "narrow", "equal", "low"])
def test_leading_pairs(d, k, space, kind):
    """Residuals at rounding level for spread, close, equal and mostly zero eigenvalues, in a subspace under the dimension."""
    rng = np.random.default_rng(d)
    turn = np.linalg.qr(rng.standard_normal((d, d)))[0]
    values = {"wide": np.geomspace(1, 1e-6, d), "narrow": 1 - np.arange(d) * 1e-3, "equal": np.r_[np.ones(k + 3), np.full(d - k - 3, 0.5)], "low": np.r_[np.arange(1.0, k - 1), np.zeros(d - k + 2)]}[kind]
    matrix = turn * values @ turn.T
    jobs = []

    def product(block):
        jobs.append(block.shape[1])
        return matrix @ block

    found, pairs = whitening.leading(product, d, k, space=space)
    assert np.allclose(found, np.sort(values)[::-1][:k], atol=1e-12)
    assert np.abs(pairs.T @ pairs - np.eye(k)).max() < 1e-12
    assert np.linalg.norm(matrix @ pairs - pairs * found, axis=0).max() < 1e-11


def test_minres():
    rng = np.random.default_rng(3)
    a = rng.standard_normal((12, 12))
    a = a + a.T
    right = np.column_stack([rng.standard_normal((12, 3)), np.zeros(12)])
    assert np.allclose(a @ whitening.minres(lambda block: a @ block, right, 12), right, atol=1e-8)
