import random

import pytest
from pyspark.sql import functions as F

from rastro.functions.running import exact_percentiles, first_rows, row_rank, running_total
from rastro.operators import index as ix
from rastro.operators import split as sp

SCHEMA = "visitorid long, timestamp long, itemid long, event string, transactionid double"


def log(spark, *rows):
    return spark.createDataFrame([(*r, "view", None) for r in rows], SCHEMA)


@pytest.fixture
def ties(spark):
    return log(spark, (1, 1, 10), (1, 2, 11), (1, 3, 12), (2, 5, 10), (3, 7, 10), (3, 7, 11))


def test_leave_one_out(ties, as_rows):
    train, test = sp.split_events(ties)
    assert as_rows(test, "visitorid", "timestamp", "itemid") == [(1, 3, 12), (3, 7, 11)]
    assert as_rows(train, "visitorid", "timestamp", "itemid") == [
        (1, 1, 10), (1, 2, 11), (2, 5, 10), (3, 7, 10),
    ]
    known = sp.known_in_train(test, train)
    assert as_rows(known, "visitorid", "itemid") == [(3, 11)]


def test_copies_of_a_test_row_stay_in_train(spark, as_rows):
    events = log(spark, (1, 1, 10), (1, 3, 12), (1, 3, 12), (1, 3, 12))
    test = sp.leave_one_out_test(events)
    train = sp.leave_one_out_train(events, test, distinct_rows=False)
    assert as_rows(test, "timestamp") == [(3,)]
    assert as_rows(train, "timestamp") == [(1,), (3,), (3,)]


def test_missing_transaction_is_not_the_newest(spark, as_rows):
    events = spark.createDataFrame(
        [(1, 5, 10, "transaction", None), (1, 5, 10, "transaction", 4.0)], SCHEMA
    )
    assert as_rows(sp.leave_one_out_test(events), "transactionid") == [(4.0,)]
    ranked = sp.recency_rank(events)
    assert as_rows(ranked, "rank_reciente", "transactionid") == [(1, 4.0), (2, None)]


def test_split_is_a_partition_of_the_log(spark, sf_dir, as_rows):
    from rastro.plans.catalog import orders_of

    events = orders_of(spark, sf_dir).cache()
    train, test = sp.split_events(events)
    assert as_rows(train.unionByName(test)) == as_rows(events)
    active = sp.active_users(events).count()
    assert test.count() == test.select("visitorid").distinct().count() == active
    events.unpersist()


@pytest.mark.parametrize("hot_rows", [3, 40, 10**6])
def test_ranks_are_the_same_when_hot_users_are_sliced(spark, hot_rows):
    rng = random.Random(5)
    rows = [(1 if rng.random() < 0.5 else rng.randrange(2, 30), t, rng.randrange(9)) for t in range(400)]
    events = log(spark, *rows)
    ranked = sp.recency_rank(events, hot_rows=hot_rows).collect()
    assert len(ranked) == 400
    expected = {}
    for u, t, _ in sorted(rows, key=lambda r: -r[1]):
        expected[(u, t)] = sum(1 for v, s, _ in rows if v == u and s > t) + 1
    assert {(r.visitorid, r.timestamp): r.rank_reciente for r in ranked} == expected


def test_running_total_with_weights_and_without_keys(spark, as_rows):
    df = spark.createDataFrame([(i, i % 3) for i in range(60)], "id long, w long")
    expected, total = [], 0
    for i in range(60):
        total += i % 3
        expected.append((i, total))
    for hot_rows in (5, 1000):
        out = running_total(df, [], [F.col("id").asc()], F.col("w"), "t", hot_rows)
        assert as_rows(out, "id", "t") == expected


def test_large_prefix_equals_small_prefix(spark, as_rows):
    df = spark.createDataFrame([(i * 7 % 101,) for i in range(101)], "id long")
    small = first_rows(df, [F.col("id").asc()], 33)
    large = first_rows(df, [F.col("id").asc()], 33, heap_rows=5)
    assert as_rows(small) == as_rows(large) == [(i,) for i in range(33)]


@pytest.mark.parametrize("hot_rows", [4, 10**6])
def test_percentiles_equal_numpy(spark, hot_rows):
    import numpy as np

    rng = np.random.default_rng(3)
    data = [("a", float(v)) for v in rng.integers(0, 12, 57)] + [("b", 4.25)]
    data += [("c", float(v)) for v in rng.random(40)] + [("c", None)]
    df = spark.createDataFrame(data, "g string, v double")
    points = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    got = {r.g: r for r in exact_percentiles(df, ["g"], "v", points, hot_rows).collect()}
    for group in "abc":
        values = [v for g, v in data if g == group and v is not None]
        for name, p in points.items():
            assert got[group][name] == pytest.approx(np.percentile(values, p * 100))


def test_index_of_any_ids(spark, as_rows):
    rng = random.Random(11)
    ids = {rng.randrange(-(2**62), 2**62) for _ in range(200)} | set(range(70000, 70300))
    ids |= {-1, 0, 1, 2**16, 2**40, 2**63 - 1, -(2**63)}
    df = spark.createDataFrame([(i,) for i in ids] * 2 + [(None,)], "visitorid long")
    got = as_rows(ix.index_ids(df, "visitorid", "u_idx"))
    assert got == [(v, i) for i, v in enumerate(sorted(ids))]


def test_interactions_and_density(spark, as_rows):
    from rastro.operators import aggregate as ag
    from rastro.operators.transform import add_weight

    events = spark.createDataFrame(
        [(1, "view", 10), (1, "addtocart", 10), (1, "view", 30), (5, "transaction", 10)],
        "visitorid long, event string, itemid long",
    )
    cells = ag.interactions(add_weight(events))
    indexed = ix.index_cells(cells)
    assert as_rows(indexed, "visitorid", "itemid", "peso", "u_idx", "i_idx") == [
        (1, 10, 4, 0, 0), (1, 30, 1, 0, 1), (5, 10, 5, 1, 0),
    ]
    assert as_rows(ag.matrix_density(cells)) == [(2, 2, 3, 75.0)]


def test_sample_is_seeded_and_without_replacement(spark, as_rows):
    users = spark.createDataFrame([(i % 50,) for i in range(500)], "visitorid long")
    one = as_rows(sp.sample_users(users, 20))
    assert len(set(one)) == 20
    assert one == as_rows(sp.sample_users(users.repartition(7), 20))
    assert one != as_rows(sp.sample_users(users, 20, seed=1))


def test_layout_does_not_change_the_split(spark, sf_dir, as_rows):
    from rastro.plans.catalog import orders_of

    before = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    try:
        for partitions in ("1", "4", "16"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            events = orders_of(spark, sf_dir).repartition(int(partitions) + 1)
            train, test = sp.split_events(events)
            results.append((as_rows(test), as_rows(ix.index_cells(train.select("visitorid", "itemid")))))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1] == results[2]


def test_rank_is_without_gaps(spark, as_rows):
    df = spark.createDataFrame([(1, i) for i in range(30)] + [(2, 1)], "u long, v long")
    ranked = row_rank(df, ["u"], [F.col("v").desc()], "r", hot_rows=10)
    assert [r for u, r in as_rows(ranked, "u", "r") if u == 1] == list(range(1, 31))
