import math
import random

import pytest

from rastro.operators import aggregate as ag
from rastro.operators import segments as sg
from rastro.operators.transform import name_clusters
from rastro.schemas import CLUSTER_NAMES, FEATURE_COLUMNS
from rastro.sources.tables import synthetic_features

NAMES = ", ".join(f"{c} double" for c in FEATURE_COLUMNS)


def test_scaling_uses_the_population_deviation(spark, as_rows):
    df = spark.createDataFrame([(1, 1.0, 4.0), (2, 3.0, 4.0)], "visitorid long, a double, b double")
    assert as_rows(sg.scale_features(df, ["a", "b"])) == [(1, -1.0, 0.0), (2, 1.0, 0.0)]


@pytest.fixture(scope="module")
def planted(spark):
    rng = random.Random(2)
    rows = []
    for user in range(600):
        level = user % 6
        base = [1, 4, 20, 90, 400, 2000][level]
        rows.append((user, *[float(base + rng.randrange(base // 4 + 1)) for _ in FEATURE_COLUMNS]))
    return spark.createDataFrame(rows, f"visitorid long, {NAMES}")


def test_kmeans_finds_planted_segments_in_order_of_activity(planted):
    labelled = sg.segment_users(planted, starts=6).collect()
    assert all(r.cluster == r.visitorid % 6 for r in labelled)
    assert {len(labelled)} == {600}


def test_kmeans_is_reproducible(planted):
    prepared = sg.prepared_features(planted)
    one = sg.fit_centers(prepared, k=4, starts=2)
    assert one == sg.fit_centers(prepared.repartition(5), k=4, starts=2)


def test_kmeans_is_as_good_as_the_best_of_single_fits(spark):
    """Three blobs too close to be certain, against Spark's own K-Means, start by start."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler

    rng = random.Random(5)
    rows = [(rng.gauss(2 * (i % 3), 1), rng.gauss(2 * (i % 3 == 1), 1)) for i in range(900)]
    rows += rows[:200]
    points = spark.createDataFrame(rows, "a double, b double").repartition(3).cache()
    centers = sg.fit_centers(points, k=5, starts=15, columns=["a", "b"])

    def cost(centers):
        return sum(min((a - c) ** 2 + (b - d) ** 2 for c, d in centers) for a, b in rows)

    assembled = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(points)
    singles = [
        cost([c.tolist() for c in KMeans(k=5, seed=s, maxIter=300).fit(assembled).clusterCenters()]) for s in range(6)
    ]
    assert cost(centers) <= 1.005 * min(singles)


def test_kmeans_with_fewer_vectors_than_centers(spark):
    points = spark.createDataFrame([(1.0,), (1.0,), (5.0,)], "a double")
    assert sg.fit_centers(points, k=4, starts=3, columns=["a"]) == [[1.0], [5.0]]


def test_nearest_center_prefers_the_lower_label(spark, as_rows):
    df = spark.createDataFrame([(1, 0.0), (2, 0.9), (3, -5.0)], "id long, a double")
    labelled = sg.assign_nearest(df, [[-1.0], [1.0]], ["a"])
    assert as_rows(labelled, "id", "cluster") == [(1, 0), (2, 1), (3, 0)]


def test_map_and_dispersion(planted, as_rows):
    segments = sg.segment_users(planted, starts=2)
    plane = sg.project_2d(segments, n=120)
    assert plane.count() == 120
    spread = sg.dispersion(plane).collect()
    assert sum(r.usuarios for r in spread) == 120
    assert sum(r.porcentaje for r in spread) == pytest.approx(100, abs=0.5)


def test_profiles(spark, as_rows):
    rows = [(0, 1.0), (0, 3.0), (1, 6.0), (2, 500.0), (3, 10.0)]
    segments = spark.createDataFrame(rows, "cluster int, a double").selectExpr("*", "5.0D AS b")
    profile = ag.cluster_profile(segments, ["a", "b"])
    assert as_rows(profile) == [(0, 2.0, 5.0), (1, 6.0, 5.0), (2, 500.0, 5.0), (3, 10.0, 5.0)]
    # The most active segment has the highest label, unless another is named.
    assert as_rows(ag.scaled_profile(profile, ["a", "b"]), "cluster") == [(0,), (1,), (2,)]
    scaled = ag.scaled_profile(profile, ["a", "b"], 2)
    assert as_rows(scaled) == [(0, 0.0, 0.0), (1, 0.5, 0.0), (3, 1.0, 0.0)]


def test_cluster_names(spark, as_rows):
    df = spark.createDataFrame([(2,), (9,)], "cluster int")
    assert as_rows(name_clusters(df, CLUSTER_NAMES), "cluster_nombre") == [
        (None,),
        ("Cluster 2 — Muy activo",),
    ]
    top = spark.createDataFrame([(3,), (0,)], "cluster int")
    assert as_rows(name_clusters(top, k=4), "cluster_nombre") == [
        ("Segmento 0 — el menos activo",),
        ("Segmento 3 — el más activo",),
    ]


def test_synthetic_features_are_lognormal_and_fixed(spark, as_rows):
    keys = spark.range(4000)
    made = synthetic_features(keys, "id")
    logs = [math.log(r.f3) for r in made.collect()]
    mean = sum(logs) / len(logs)
    deviation = (sum((x - mean) ** 2 for x in logs) / len(logs)) ** 0.5
    assert mean == pytest.approx(1.5, abs=0.08) and deviation == pytest.approx(1.2, abs=0.08)
    assert as_rows(made) == as_rows(synthetic_features(keys.repartition(3), "id"))
