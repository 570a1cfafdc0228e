import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rastro.operators import negatives as ng
from rastro.operators import ranker as rk
from rastro.operators import recommend as rec
from rastro.operators import topn
from rastro.plans import fixed


@pytest.fixture(scope="module")
def cells(spark):
    """Users of four tastes act on the items of their taste; user 0 on nearly all."""
    rng = random.Random(7)
    rows = {}
    for user in range(1, 80):
        for _ in range(14):
            item = 4 * rng.randrange(12) + user % 4
            rows[(user, item)] = rng.choice([1, 3, 5])
    for item in range(45):
        rows[(0, item)] = 1
    data = [(u, i, w) for (u, i), w in rows.items()]
    return spark.createDataFrame(data, "u_idx long, i_idx long, peso long").cache()


@pytest.fixture(scope="module")
def model(cells):
    return rec.fit_als(cells, factors=8, iterations=8)


def expected_lists(model, cells, n):
    users = {r.id: np.array(r.features) for r in model.userFactors.collect()}
    items = {r.id: np.array(r.features) for r in model.itemFactors.collect()}
    seen = {(r.u_idx, r.i_idx) for r in cells.collect()}
    lists = {}
    for u, vector in users.items():
        scored = [(-float(vector @ f), i) for i, f in items.items() if (u, i) not in seen]
        lists[u] = [i for _, i in sorted(scored)[:n]]
    return lists


@pytest.mark.parametrize("slice_bytes, step, few", [(64 << 20, 4096, 1000), (8 * 4 * 11, 5, 10)])
def test_lists_equal_brute_force(cells, model, slice_bytes, step, few, monkeypatch):
    """In one slice, and in slices of 11 items scored five at a time, users joined."""
    monkeypatch.setattr(topn, "SLICE_BYTES", slice_bytes)
    monkeypatch.setattr(topn, "STEP_ITEMS", step)
    monkeypatch.setattr(topn, "FEW", few)
    lists = rec.top_n_unseen(model, cells.select("u_idx"), cells, 5).collect()
    got = {}
    for r in sorted(lists, key=lambda r: r["rank"]):
        got.setdefault(r.u_idx, []).append(r.i_idx)
        assert r["rank"] == len(got[r.u_idx])
    expected = expected_lists(model, cells, 5)
    assert got == expected
    assert len(got[0]) == 3  # all that user 0 has left of 48 items


@pytest.mark.parametrize("slice_bytes, step", [(64 << 20, 4096), (3 * 8 * 7, 3)])
def test_places_and_lists_with_ties_equal_brute_force(spark, slice_bytes, step, monkeypatch):
    monkeypatch.setattr(topn, "SLICE_BYTES", slice_bytes)
    monkeypatch.setattr(topn, "STEP_ITEMS", step)
    rng = random.Random(11)
    users = {u: [float(rng.randrange(-1, 3)) for _ in range(3)] for u in range(25)}
    items = {i: [float(rng.randrange(-2, 3)) for _ in range(3)] for i in range(60)}
    users[3] = [0.0, 0.0, 0.0]
    seen = {(u, i) for u in users for i in items if rng.random() < 0.2} | {(7, i) for i in range(58)}
    index = topn.RankIndex(
        spark.createDataFrame([(100 + u, u, v) for u, v in users.items()], "visitorid long, u_idx long, features array<double>"),
        spark.createDataFrame([(1000 - i, i, v) for i, v in items.items()], "itemid long, i_idx long, features array<double>"),
        spark.createDataFrame(sorted(seen), "u_idx long, i_idx long"),
    )
    order = {
        u: sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in items.items() if (u, i) not in seen)
        for u, v in users.items()
    }
    asked = spark.createDataFrame([(100 + u,) for u in users] + [(100,), (9999,), (None,)], "visitorid long")
    expected = [(100 + u, k, 1000 - i, -s) for u in users for k, (s, i) in enumerate(order[u][:4], 1)]
    assert sorted(map(tuple, index.lists(asked, 4).collect())) == sorted(expected)
    pairs = [(u, i) for u in users for i in rng.sample(range(60), 3)]
    places = {u: {i: k for k, (_, i) in enumerate(own, 1)} for u, own in order.items()}
    test = spark.createDataFrame([(100 + u, 1000 - i) for u, i in pairs] + [(5, 5)], "visitorid long, itemid long")
    found = {(r.visitorid, r.itemid): r["rank"] for r in index.places(test).collect()}
    assert found == {(100 + u, 1000 - i): places[u].get(i) for u, i in pairs}
    assert index.lists(asked.filter("visitorid = 0"), 4).collect() == []
    index.close()


def test_a_scan_stops_behind_the_last_item_that_can_matter():
    """Ten long vectors, and many short ones that are never scored."""
    draw = np.random.default_rng(1)
    vectors = draw.normal(size=(50_000, 8)) * 0.01
    vectors[:10] = 5 + draw.normal(size=(10, 8))
    import pyarrow as pa

    table = pa.table({"i_idx": np.arange(50_000), "itemid": np.arange(50_000), "features": list(vectors)})
    items, steps = topn._Slice(table, False), []
    lists = topn._Lists(5, *([np.zeros(0, k)] for k in (np.int64, np.int64, np.float64)))

    def visit(low, rows, scores):
        steps.append(low)
        lists.visit(items, low, rows, scores)

    user = np.ones((1, 8))
    topn._scan(items, user, (np.zeros(1, np.int64), np.array([3])), lambda: lists.need, visit)
    assert steps == [0]
    scores = vectors @ user[0]
    scores[3] = -np.inf
    assert lists.ids[0].tolist() == np.argsort(-scores)[:5].tolist()


def test_als_beats_popularity_on_planted_tastes(spark, cells, model):
    rng = random.Random(3)
    seen = {(r.u_idx, r.i_idx) for r in cells.collect()}
    test = []
    for user in range(1, 80):
        left = [4 * j + user % 4 for j in range(12) if (user, 4 * j + user % 4) not in seen]
        if left:
            test.append((user, rng.choice(left)))
    lists = {}
    for r in rec.top_n_unseen(model, cells.select("u_idx"), cells, 5).collect():
        lists.setdefault(r.u_idx, set()).add(r.i_idx)
    als_hits = sum(i in lists[u] for u, i in test) / len(test)
    events = cells.select(F.col("u_idx").alias("visitorid"), F.col("i_idx").alias("itemid"), F.col("peso").alias("peso_implicito"))
    popular = {}
    for r in fixed.fixed_recommendations(events, fixed.by_weight(), 5).collect():
        popular.setdefault(r.visitorid, set()).add(r.itemid)
    popular_hits = sum(i in popular[u] for u, i in test) / len(test)
    assert als_hits > 0.6 > popular_hits


def test_pair_scores_are_inner_products(spark, cells, model, as_rows):
    users = {r.id: np.array(r.features) for r in model.userFactors.collect()}
    items = {r.id: np.array(r.features) for r in model.itemFactors.collect()}
    pairs = cells.select("u_idx", "i_idx").limit(20)
    for r in rec.score_pairs(pairs, model.userFactors, model.itemFactors).collect():
        assert r.score == pytest.approx(float(users[r.u_idx] @ items[r.i_idx]), abs=1e-5)


def draw(n_items, *parts):
    text = ":".join(str(p) for p in parts)
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16) % n_items


def test_training_negatives_equal_brute_force(spark, cells):
    seen = {(r.u_idx, r.i_idx) for r in cells.collect()}
    positives = [(u, i, t) for u, i in sorted(seen) for t in (1, 2) if (u + i + t) % 3]
    df = spark.createDataFrame(positives, "u_idx long, i_idx long, t long")
    got = sorted(
        (r.u_idx, r.i_idx, r.label)
        for r in ng.training_pairs(df, cells, 48, ["u_idx", "i_idx", "t"], 4, seed=9, epoch=2).collect()
    )
    expected, short = [], 0
    for u, i, t in positives:
        expected.append((u, i, 1.0))
        found = [c for c in (draw(48, 9, 2, u, i, t, k) for k in range(40)) if (u, c) not in seen][:4]
        short += len(found) < 4
        expected += [(u, c, 0.0) for c in found]
    assert short > 0  # user 0 has seen 45 of 48 items
    assert got == sorted(expected)


def evaluation_draws(u, true_item, n_items, taken, n, seed):
    """The rule, item by item: 6·n tries, then draws from what is unseen."""
    tries = (draw(n_items, seed, 0, u, true_item, k) for k in range(6 * n))
    found = [c for c in tries if c not in taken][:n]
    unseen = [i for i in range(n_items) if i not in taken]
    for d in range(n - len(found)):
        found.append(unseen[draw(len(unseen), seed, 0, u, true_item, 6 * n + d)])
    return sorted(found)


def test_evaluation_negatives_equal_brute_force(spark, cells):
    seen = {(r.u_idx, r.i_idx) for r in cells.collect()}
    pairs = [(0, 2), (1, 5), (2, 47)]
    full = [(99, i) for i in range(48)]
    all_seen = cells.select("u_idx", "i_idx").union(spark.createDataFrame(full, "u_idx long, i_idx long"))
    df = spark.createDataFrame([*pairs, (99, 3)], "u_idx long, i_idx long")
    got = {}
    for r in ng.evaluation_negatives(df, all_seen, 48, n=30, seed=4).collect():
        got.setdefault((r.u_idx, r.i_idx), []).append(r.neg_idx)
    assert set(got) == set(pairs)  # nothing is left to draw for user 99
    for u, i in pairs:
        taken = {c for v, c in seen if v == u} | {i}
        assert sorted(got[(u, i)]) == evaluation_draws(u, i, 48, taken, 30, 4)


def test_a_user_who_has_seen_nearly_all_of_a_large_catalogue(spark):
    import time

    n_items, left = 100_000, {17, 99_998}
    seen = spark.range(n_items).filter(~F.col("id").isin(*left)).select(F.lit(5).cast("long").alias("u_idx"), F.col("id").alias("i_idx"))
    pairs = spark.createDataFrame([(5, 40)], "u_idx long, i_idx long")
    start = time.perf_counter()
    got = [r.neg_idx for r in ng.evaluation_negatives(pairs, seen, n_items).collect()]
    assert time.perf_counter() - start < 60
    assert len(got) == 99 and set(got) == left
    unseen = sorted(left)
    assert sorted(got) == sorted(unseen[draw(2, 42, 0, 5, 40, 6 * 99 + d)] for d in range(99))


def test_tries_per_negative_and_shortfall(spark, cells):
    positives = spark.createDataFrame([(0, i) for i in range(45)], "u_idx long, i_idx long")
    missing = []
    for tries in (1, 10, 60):
        pairs = ng.training_pairs(positives, cells, 48, ["u_idx", "i_idx"], 4, tries_per_negative=tries)
        row = ng.training_shortfall(pairs, 4).first()
        assert row.positivos == 45 and row.negativos + row.faltan == 180
        missing.append(row.faltan)
    assert missing[0] > missing[1] > missing[2]


def test_pairs_without_negatives_are_not_hits(spark):
    from rastro.operators import evaluate as ev

    true = spark.createDataFrame([(1, 7, 0.5), (2, 8, 0.5)], "u_idx long, i_idx long, score double")
    negatives = spark.createDataFrame(
        [(1, 7, 3, 0.9), (1, 7, 4, 0.1)], "u_idx long, i_idx long, neg_idx long, score double"
    )
    assert [tuple(r) for r in ev.sampled_ranks(true, negatives).collect()] == [(1, 7, 2)]
    assert ev.sampled_metrics(true, negatives).first().usuarios_evaluados == 1
    assert tuple(ev.left_out(true, negatives, 2).first()) == (2, 1, 0)


def test_ranker_learns_planted_tastes(spark, cells, model):
    seen = cells.select("u_idx", "i_idx")
    pairs = ng.training_pairs(seen, cells, 48, ["u_idx", "i_idx"], 4).cache()
    network = rk.fit_ranker(pairs, model.userFactors, model.itemFactors, 8, iterations=60)
    grid = [(u, i) for u in range(1, 40) for i in range(48)]
    df = spark.createDataFrame(grid, "u_idx long, i_idx long")
    scored = rk.score_with_ranker(network, df, model.userFactors, model.itemFactors).collect()
    own = [r.score for r in scored if r.i_idx % 4 == r.u_idx % 4]
    other = [r.score for r in scored if r.i_idx % 4 != r.u_idx % 4]
    assert sum(own) / len(own) > 2 * sum(other) / len(other)
    assert 0 <= min(own + other) and max(own + other) <= 1
