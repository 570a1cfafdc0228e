"""Neighbour graph and map: recall, kept neighbours, all users placed."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rastro.operators import neighbours as nb
from rastro.schemas import FEATURE_COLUMNS
from rastro.session import pinned


def exact(vectors, k):
    squares = ((vectors[:, None] - vectors[None]) ** 2).sum(axis=2)
    np.fill_diagonal(squares, np.inf)
    return {(a, int(b)) for a, row in enumerate(squares) for b in np.argsort(row)[:k]}


@pytest.fixture(scope="module")
def blobs(spark):
    draw = np.random.default_rng(1)
    vectors = np.concatenate([draw.normal(3 * c, 1, (250, 6)) for c in range(6)])
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    return vectors, pinned(spark.createDataFrame(rows, "id long, v array<double>"))


@pytest.fixture(scope="module")
def graph(blobs):
    return nb.neighbour_graph(blobs[1], 10)


def test_recall_of_the_graph(blobs, graph):
    found = {(r.a, r.b) for r in graph.collect()}
    expected = exact(blobs[0], 10)
    assert len(found) == len(expected) == 10 * len(blobs[0])
    assert len(found & expected) / len(expected) >= 0.97
    one = graph.filter("a = 7").orderBy("place").collect()
    assert [r.place for r in one] == list(range(1, 11))
    assert one[0].d == pytest.approx(((blobs[0][7] - blobs[0][one[0].b]) ** 2).sum())


def test_the_layout_keeps_more_neighbours_than_components(blobs, graph):
    vectors, points = blobs
    places = nb.layout(points, graph)
    assert places.count() == len(vectors)
    before = nb.layout(points, graph, steps=0)
    kept, by_components = (nb.kept_neighbours(graph, p, 10) for p in (places, before))
    assert kept > 1.4 * by_components


def test_a_hub_and_copies(spark):
    """A point that is everybody's neighbour, and points at one place."""
    circle = [[np.cos(i), np.sin(i), 0.0] for i in range(120)]
    rows = enumerate([[0.0] * 3, *circle, *[[9.0] * 3] * 20])
    rows = [(i, [float(x) for x in v]) for i, v in rows]
    points = pinned(spark.createDataFrame(rows, "id long, v array<double>"))
    graph = nb.neighbour_graph(points, 5)
    counts = graph.groupBy("a").count().agg(F.min("count"), F.max("count"), F.count("a")).first()
    assert tuple(counts) == (5, 5, 141)
    assert graph.filter("a > 120 AND d > 0").count() == 0


def test_every_user_has_a_place_and_few_points_do(spark):
    names = ", ".join(f"{c} double" for c in FEATURE_COLUMNS)
    rows = [(u, u % 2, *[float((u % 7) * (j + 1) % 5) for j in range(len(FEATURE_COLUMNS))]) for u in range(60)]
    segments = spark.createDataFrame(rows, f"visitorid long, cluster int, {names}")
    found = nb.neighbour_map(segments, k=3, steps=3).collect()
    assert sorted(r.visitorid for r in found) == list(range(60))
    assert all(np.isfinite([r.x, r.y]).all() for r in found)
    assert len({(r.x, r.y) for r in found}) <= 7
    alone = nb.neighbour_map(segments.limit(1), k=3, steps=2).collect()
    assert len(alone) == 1
