import pytest

from rastro.operators import aggregate as ag
from rastro.operators import evaluate as ev


@pytest.fixture
def lists(spark):
    recs = [(1, 1, 100), (2, 3, 200), (3, 1, 999), (4, 7, 400)]
    return spark.createDataFrame(recs, "visitorid long, rank int, itemid long")


@pytest.fixture
def test_rows(spark):
    return spark.createDataFrame(
        [(1, 100), (2, 200), (3, 300), (4, 400)], "visitorid long, itemid long"
    )


def test_full_protocol(test_rows, lists, as_rows):
    row = ev.full_metrics(test_rows, lists).first()
    assert row["usuarios_evaluados"] == 4
    assert row["hit_rate@10"] == pytest.approx(0.75)
    assert row["map@10"] == pytest.approx(0.369048, abs=1e-6)
    assert row["ndcg@10"] == pytest.approx(0.458333, abs=1e-6)
    assert as_rows(ev.user_hits(test_rows, lists)) == [(1, 1), (2, 1), (3, 0), (4, 1)]
    assert as_rows(ev.user_hits(test_rows, lists, k=5)) == [(1, 1), (2, 1), (3, 0), (4, 0)]


def test_nothing_to_evaluate(test_rows, lists):
    row = ev.full_metrics(test_rows.limit(0), lists).first()
    assert tuple(row) == (0, 0.0, 0.0, 0.0)


def test_tied_scores_count_against_the_true_item(spark):
    true = spark.createDataFrame([(1, 9, 0.7), (2, 9, 0.5)], "u_idx long, i_idx long, score double")
    negatives = spark.createDataFrame(
        [(1, 9, 3, 0.9), (1, 9, 4, 0.7), (1, 9, 4, 0.7), (1, 9, 5, 0.1)],
        "u_idx long, i_idx long, neg_idx long, score double",
    )
    ranks = {r.u_idx: r["rank"] for r in ev.sampled_ranks(true, negatives).collect()}
    # User 2 has no negatives, so it has no rank; it used to count as a perfect hit.
    assert ranks == {1: 4}


def test_hit_rate_by_cluster(spark, as_rows):
    hits = spark.createDataFrame([(1, 1), (2, 0), (3, 1)], "visitorid long, hit int")
    segments = spark.createDataFrame([(1, 0), (2, 0)], "visitorid long, cluster int")
    assert as_rows(ag.hit_rate_by_cluster(hits, segments)) == [(None, 1.0, 1), (0, 0.5, 2)]


def test_model_comparison(spark):
    schema = "usuarios_evaluados long, `hit_rate@10` double, `map@10` double, `ndcg@10` double"
    als = spark.createDataFrame([(5000, 0.6718, 0.4535, 0.5045)], schema)
    neural = spark.createDataFrame([(5000, 0.7588, 0.5928, 0.0)], schema)
    got = {r.metrica: r for r in ev.compare_models({"als": als, "neural": neural}, "als").collect()}
    assert got["hit_rate@10"].mejora_neural_pct == pytest.approx(12.9503, abs=1e-4)
    assert got["map@10"].neural == 0.5928 and got["ndcg@10"].mejora_neural_pct == -100.0
