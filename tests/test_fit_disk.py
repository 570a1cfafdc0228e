"""Fits and draws leave no shuffle files behind, and phases change nothing."""

import random

import numpy as np
import pytest
from pyspark.ml.recommendation import ALS
from pyspark.sql import functions as F

from rastro.operators import implicit as im
from rastro.operators import negatives as ng
from rastro.operators import recommend as rec
from rastro.session import pinned


def shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files, found = disk.getAllFiles().iterator(), set()
    while files.hasNext():
        name = files.next().getName()
        if name.startswith("shuffle_") and name.endswith(".data"):
            found.add(name)
    return found


@pytest.fixture(scope="module")
def cells(spark):
    rng = random.Random(3)
    pairs = {(rng.randrange(60), 3 * rng.randrange(40)) for _ in range(700)} | {(7, 3 * i) for i in range(40)}
    rows = [(u, i, rng.choice([1, 3, 5])) for u, i in sorted(pairs) if u != 11]
    return pinned(spark.createDataFrame(rows, "u_idx long, i_idx long, peso long"))


def matrix(table):
    rows = sorted((r.id, list(r.features)) for r in table.collect())
    return [r[0] for r in rows], np.array([r[1] for r in rows])


def test_a_pinned_table_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    table = pinned(spark.range(10_000).groupBy((F.col("id") % 1000).alias("k")).agg(F.sum("id").alias("n")))
    assert not shuffle_files(spark) - before
    assert table.count() == 1000


def test_als_is_that_of_spark_and_leaves_little(spark, cells):
    theirs = ALS(
        rank=8, maxIter=6, regParam=0.01, implicitPrefs=True, alpha=1.0, seed=42, userCol="u_idx", itemCol="i_idx",
        ratingCol="peso", numUserBlocks=10, numItemBlocks=10,
    ).fit(cells)
    before = shuffle_files(spark)
    model = rec.fit_als(cells, factors=8, iterations=6)
    # Those of the first draw, which has one row for each user, and of counts; none of a half step.
    assert len({f.split("_")[1] for f in shuffle_files(spark) - before}) <= 9
    for own, other in ((model.userFactors, theirs.userFactors), (model.itemFactors, theirs.itemFactors)):
        (ids, rows), (their_ids, their_rows) = matrix(own), matrix(other)
        assert ids == their_ids and 11 not in ids[7:]
        assert rows == pytest.approx(their_rows, rel=1e-3, abs=1e-5)
    pair = spark.createDataFrame([(7, 3)], "u_idx int, i_idx int")
    assert model.transform(pair).first().prediction == pytest.approx(theirs.transform(pair).first().prediction, abs=1e-5)


def test_phases_change_nothing(spark, cells, monkeypatch):
    once = matrix(im.fit_implicit(cells, 60, 118, factors=4, iterations=1, blocks=4).itemFactors)
    monkeypatch.setattr(im, "PHASE_BYTES", 1)
    again = matrix(im.fit_implicit(cells, 60, 118, factors=4, iterations=1, blocks=4).itemFactors)
    assert once[0] == again[0] == list(range(118))
    assert once[1] == pytest.approx(again[1], abs=1e-6)


def test_rows_with_few_and_many_cells_are_solved_exactly(monkeypatch):
    monkeypatch.setattr(im, "WALK", 5)
    draw = np.random.default_rng(1)
    others, weights = draw.normal(size=(30, 4)).astype(np.float32), np.zeros((5, 30), np.float32)
    weights[0, :2], weights[1, :30], weights[2, 3:9], weights[3, 1] = 5, 3, 2, 1
    weights[3, 2] = -1
    u, i = np.nonzero(weights)
    rows = im.solve_scaled(im.Cells(u, i, weights[u, i]), others, others.T.astype(float) @ others, 5, 0.1, 2.0)
    for k, own in enumerate(weights):
        y, w = others[own != 0].astype(float), own[own != 0]
        a = others.T.astype(float) @ others + (y.T * (2 * abs(w))) @ y + 0.1 * (w > 0).sum() * np.eye(4)
        assert rows[k] == pytest.approx(np.linalg.solve(a, y.T @ np.where(w > 0, 1 + 2 * abs(w), 0)), abs=1e-4)


def test_training_draws_n_tries_for_all(spark, monkeypatch):
    """Only positives with a seen draw go on, each with what it misses; seen pairs may repeat."""
    tries, plain = [], ng._round

    def counted(wanted, *rest):
        tries.append((wanted.count(), wanted.agg(F.max("_missing")).first()[0], rest[-1]))
        return plain(wanted, *rest)

    monkeypatch.setattr(ng, "_round", counted)
    positives = pinned(spark.range(200).select(F.col("id").alias("u_idx"), (F.col("id") % 50).alias("i_idx")))
    more = positives.unionByName(positives.select("u_idx", (F.col("u_idx") % 31 + 60).alias("i_idx")))
    found = pinned(ng.training_negatives(positives, more.unionByName(more), 100, ["u_idx", "i_idx"], 4))
    assert found.count() == 800
    assert found.join(more, ["u_idx", "i_idx"]).isEmpty()
    assert tries and all(n < 40 and most <= 4 and first >= 4 for n, most, (first, _) in tries)
