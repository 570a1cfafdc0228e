"""The ranker with learned vectors: gradients, negatives, blocks, and what it learns."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rastro.operators import neural as nn
from rastro.operators import recommend as rec

SMALL = nn.Shape(factor=8, deep=8, hidden=(16, 8))


def test_gradients_equal_differences():
    draw = np.random.default_rng(1)
    shape = nn.Shape(factor=3, deep=2, hidden=(5, 4))
    flat = draw.normal(size=shape.size())
    users, items = draw.normal(size=(2, 6, shape.width))
    labels = draw.integers(0, 2, 6).astype(float)
    _, by_network, by_user, by_item = nn.gradients(shape, flat, users, items, labels)

    def loss(*given):
        return nn.gradients(shape, *given, labels)[0] / 6

    given = [flat, users, items]
    for k, slopes in enumerate((by_network, by_user, by_item)):
        for at in range(given[k].size):
            up, down = [g.copy() for g in given], [g.copy() for g in given]
            up[k].flat[at] += 1e-6
            down[k].flat[at] -= 1e-6
            assert slopes.flat[at] == pytest.approx((loss(*up) - loss(*down)) / 2e-6, abs=1e-6)


def test_a_step_sums_gradients_by_id():
    block = nn.Block(np.zeros((4, 2), np.float32), np.zeros(4, np.int32))
    ids = np.array([2, 0, 2])
    block.step(ids, np.array([[1, 0], [0, 1], [3, 0]], np.float32), 0.1)
    assert block.first[2].tolist() == pytest.approx([0.4, 0])
    assert block.rows[2].tolist() == pytest.approx([-0.1, 0]) and block.rows[0].tolist() == pytest.approx([0, -0.1])
    assert block.steps.tolist() == [1, 0, 1, 0] and not block.rows[1].any()
    again = nn.Block.unpack(block.pack(), 2)
    assert (again.rows == block.rows).all() and (again.touched == block.touched).all()


def test_negatives_are_unseen_and_follow_the_positives():
    draw = np.random.default_rng(2)
    count = np.array([0, 10, 400, 3])
    seen = np.array(sorted({1 * 20 + 4, *(2 * 20 + i for i in range(19)), *(3 * 20 + i for i in range(20))}))
    users, items = nn.negatives_of(draw, count, 0.5, 4, 20, seen)
    assert not set((users * 20 + items).tolist()) & set(seen.tolist())
    assert np.bincount(users, minlength=4).tolist()[:2] == [0, 20]
    assert set(items[users == 2].tolist()) == {19}
    assert 3 not in users  # nothing is left of this block


def test_copies_are_averaged_by_their_steps():
    blocks = []
    for value, touched in ((1.0, [1, 0, 0]), (3.0, [3, 2, 0])):
        block = nn.Block(np.full((3, 1), value, np.float32), np.zeros(3, np.int32))
        block.touched = np.array(touched, np.int32)
        block.steps = block.touched + 5
        blocks.append(block)
    merged = nn.averaged(iter(blocks))
    assert merged.rows.ravel().tolist() == [2.5, 3.0, 1.0]
    assert merged.steps.tolist() == [8, 7, 5]


@pytest.fixture(scope="module")
def cells(spark):
    """Users of four tastes act on the items of their taste."""
    rng = random.Random(7)
    rows = {(u, 4 * rng.randrange(12) + u % 4) for u in range(80) for _ in range(12)}
    return spark.createDataFrame(sorted(rows), "u_idx long, i_idx long").cache()


def hits(spark, cells, scored):
    """Of the unseen items of each user's taste, the share among its best five."""
    seen = {tuple(r) for r in cells.collect()}
    best = {}
    for r in scored:
        if (r.u_idx, r.i_idx) not in seen:
            best.setdefault(r.u_idx, []).append((-r.score, r.i_idx))
    good = total = 0
    for u, own in best.items():
        left = {i for _, i in own if i % 4 == u % 4}
        good += len(left & {i for _, i in sorted(own)[:5]})
        total += min(5, len(left))
    return good / total


@pytest.fixture(scope="module")
def fitted(cells):
    return nn.fit_neural(cells, 80, 48, epochs=10, batch=32, rate=0.01, shape=SMALL, user_blocks=3, item_blocks=3)


def test_it_learns_tastes_better_than_als(spark, cells, fitted):
    grid = spark.range(80 * 48).select(F.floor(F.col("id") / 48).alias("u_idx"), (F.col("id") % 48).alias("i_idx"))
    scored = fitted.score(grid).collect()
    assert len(scored) == 80 * 48 and all(0 <= r.score <= 1 for r in scored)
    als = rec.fit_als(cells.withColumn("peso", F.lit(1)), factors=8, iterations=8)
    by_als = rec.score_pairs(grid, als.userFactors, als.itemFactors).collect()
    assert hits(spark, cells, scored) >= max(0.95, hits(spark, cells, by_als))


def test_losses_fall_and_fits_repeat(cells, fitted):
    assert len(fitted.losses) == 10
    assert fitted.losses[-1] < 0.5 * fitted.losses[0]
    short = [
        nn.fit_neural(cells.repartition(n), 80, 48, epochs=1, batch=32, shape=SMALL, user_blocks=3, item_blocks=2)
        for n in (1, 5)
    ]
    assert short[0].losses == short[1].losses
    assert sorted(map(tuple, short[0].users.collect())) == sorted(map(tuple, short[1].users.collect()))


def test_more_user_blocks_than_item_blocks(spark, cells):
    fit = nn.fit_neural(cells, 80, 48, epochs=16, batch=16, rate=0.02, shape=SMALL, user_blocks=4, item_blocks=2)
    grid = spark.range(80 * 48).select(F.floor(F.col("id") / 48).alias("u_idx"), (F.col("id") % 48).alias("i_idx"))
    assert hits(spark, cells, fit.score(grid).collect()) > 0.8
    assert fit.users.count() == 80 and fit.items.count() == 48


def test_more_blocks_than_ids_and_unknown_pairs(spark):
    pairs = spark.createDataFrame([(0, 0), (1, 1), (1, 1)], "u_idx long, i_idx long")
    fit = nn.fit_neural(pairs, 2, 2, epochs=1, shape=SMALL, user_blocks=4, item_blocks=4)
    asked = spark.createDataFrame([(0, 1, "x"), (7, 0, "y")], "u_idx long, i_idx long, score_of string")
    assert [r.score_of for r in fit.score(asked).collect()] == ["x"]
