"""Factors under the plain objective: normal equations, a plain fit, planted tastes."""

import random

import numpy as np
import pytest

from rastro.operators import implicit as im


def plain_half(weights, others, regularization):
    """Exact rows, one by one."""
    gram = others.T @ others
    rows = np.zeros((len(weights), others.shape[1]))
    for k, own in enumerate(weights):
        seen = np.flatnonzero(own)
        y = others[seen]
        a = gram + y.T @ ((own[seen] - 1)[:, None] * y) + regularization * np.eye(len(gram))
        rows[k] = np.linalg.solve(a, y.T @ own[seen])
    return rows


@pytest.fixture(scope="module")
def weights():
    rng, out = random.Random(7), np.zeros((80, 48))
    for user in range(79):
        for _ in range(14):
            out[user, 4 * rng.randrange(12) + user % 4] = rng.choice([1, 3, 5])
    out[3, :45] = 1
    return out


@pytest.fixture(scope="module")
def cells(spark, weights):
    rows = [(int(u), int(i), int(weights[u, i])) for u, i in zip(*np.nonzero(weights))]
    return spark.createDataFrame(rows, "u_idx long, i_idx long, peso long").cache()


def test_conjugate_gradients_reach_the_exact_rows(weights):
    draw = np.random.default_rng(1)
    others = draw.normal(size=(48, 6))
    u, i = np.nonzero(weights)
    cells = im.Cells(u, i, weights[u, i])
    rows, rest = im.solve(im.Cells.unpack(cells.pack()), others, others.T @ others, np.zeros((80, 6)), 0.01, 40, 1e-10)
    assert rest <= 1e-9
    assert rows == pytest.approx(plain_half(weights, others, 0.01), abs=1e-6)
    assert not rows[79].any()


def matrix(table, n):
    found = {r.id: r.features for r in table.collect()}
    assert sorted(found) == list(range(n))
    return np.array([found[k] for k in range(n)])


def test_fit_against_the_plain_objective(spark, cells, weights):
    fit = im.fit_implicit(cells, 80, 48, factors=6, iterations=8, blocks=5)
    x, y = matrix(fit.userFactors, 80), matrix(fit.itemFactors, 48)
    assert y == pytest.approx(plain_half(weights.T, x, 0.01), rel=1e-3, abs=1e-4)

    def cost(x, y):
        confidence = np.where(weights > 0, weights, 1)
        return (confidence * ((weights > 0) - x @ y.T) ** 2).sum() + 0.01 * ((x**2).sum() + (y**2).sum())

    draw = np.random.default_rng(0)
    a, b = draw.normal(0, 0.01, (80, 6)), draw.normal(0, 0.01, (48, 6))
    for _ in range(8):
        a = plain_half(weights, b, 0.01)
        b = plain_half(weights.T, a, 0.01)
    assert cost(x, y) <= 1.05 * cost(a, b)
    scores = x @ y.T
    own = [scores[u, i] for u in range(4, 79) for i in range(48) if i % 4 == u % 4 and not weights[u, i]]
    other = [scores[u, i] for u in range(4, 79) for i in range(48) if i % 4 != u % 4]
    assert np.mean(own) > 5 * abs(np.mean(other))


def test_normal_equations_hold_for_items_and_not_for_others(spark, cells):
    fit = im.fit_implicit(cells, 80, 48, factors=4, iterations=2, blocks=3)
    rest = im.normal_equations(cells, fit.itemFactors, fit.userFactors, "i_idx", "u_idx").collect()
    assert len(rest) == 48 and max(r.residuo for r in rest) < 1e-4
    early = im.normal_equations(cells, fit.userFactors, fit.itemFactors, "u_idx", "i_idx").collect()
    assert max(r.residuo for r in early) > 1e-3


def test_more_blocks_than_rows(spark):
    cells = spark.createDataFrame([(0, 0, 1), (1, 1, 5)], "u_idx long, i_idx long, peso long")
    fit = im.fit_implicit(cells, 2, 2, factors=2, iterations=2, blocks=4)
    assert fit.userFactors.count() == fit.itemFactors.count() == 2
