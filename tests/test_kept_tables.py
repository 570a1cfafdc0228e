"""Tables that are kept between runs: dictionaries, the log by user, sketches by day."""

import pytest
from pyspark.sql import functions as F

from rastro.operators import aggregate as ag
from rastro.operators import dictionary as dc
from rastro.operators import index as ix
from rastro.operators import sketches as sk
from rastro.operators import split as sp
from rastro.plans.catalog import orders_of
from rastro.session import pinned
from rastro.sources.user_log import open_user_log, split_within_buckets, write_user_log


def ids(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "id long")


def test_given_indices_never_move(spark, tmp_path, as_rows):
    path = str(tmp_path / "dictionary")
    assert dc.read_dictionary(spark, path).count() == 0
    first = dc.extend_dictionary(ids(spark, 30, 10, None, 30), path, "01")
    assert as_rows(first) == [(10, 0, "01"), (30, 1, "01")]
    second = dc.extend_dictionary(ids(spark, 20, 10, -5), path, "02")
    assert as_rows(second) == [(-5, 2, "02"), (10, 0, "01"), (20, 3, "02"), (30, 1, "01")]
    # Nothing new, an empty load, and a repeated load.
    assert dc.extend_dictionary(ids(spark, 20, None), path, "03").count() == 4
    assert dc.extend_dictionary(ids(spark), path, "04").count() == 4
    assert as_rows(dc.extend_dictionary(ids(spark, 7), path, "05")) == as_rows(
        dc.extend_dictionary(ids(spark, 7), path, "05")
    )


def test_only_the_newest_load_is_written_again(spark, tmp_path, as_rows):
    path = str(tmp_path / "dictionary")
    dc.extend_dictionary(ids(spark, 1), path, "01")
    dc.extend_dictionary(ids(spark, 2, 3), path, "02")
    # The load was wrong: its rows go, those before it stay.
    assert as_rows(dc.extend_dictionary(ids(spark, 4), path, "02")) == [(1, 0, "01"), (4, 1, "02")]
    with pytest.raises(ValueError, match="older"):
        dc.extend_dictionary(ids(spark, 9), path, "01")


def test_one_load_is_the_plain_index(spark, sf_dir, tmp_path, as_rows):
    log = pinned(orders_of(spark, sf_dir))
    kept = dc.extend_dictionary(log, str(tmp_path / "users"), "a", "visitorid", "u_idx")
    assert as_rows(kept.drop("carga")) == as_rows(ix.index_ids(log, "visitorid", "u_idx"))


@pytest.fixture(scope="module")
def log(spark, sf_dir):
    return pinned(orders_of(spark, sf_dir))


@pytest.mark.parametrize("hot_rows", [25, 10**6])
def test_user_log_gives_what_the_log_gives(spark, log, tmp_path, as_rows, hot_rows):
    events = log.withColumn("visitorid", F.when(F.col("visitorid") % 3 == 0, 3).otherwise(F.col("visitorid")))
    events = pinned(events.distinct())
    kept = write_user_log(events, str(tmp_path / "log"), 4, hot_rows)
    assert (kept.hot.count() > 0) == (kept.ordinary.filter("visitorid = 3").count() == 0)
    assert as_rows(kept.by_user(lambda part: part)) == as_rows(events)
    for operator in (ag.user_features, sp.events_of_active_users, ag.interactions):
        assert as_rows(kept.by_user(operator)) == as_rows(operator(events))
    for found, want in zip(kept.split(), sp.split_events(events)):
        assert as_rows(found) == as_rows(want)
    again = open_user_log(spark, str(tmp_path / "log"))
    assert as_rows(again.by_user(ag.user_features)) == as_rows(ag.user_features(events))


def test_rows_without_a_user_and_an_empty_log(spark, log, tmp_path, as_rows):
    some = log.limit(5).unionByName(log.limit(3).withColumn("visitorid", F.lit(None).cast("bigint")))
    kept = write_user_log(pinned(some), str(tmp_path / "some"), 2)
    assert (kept.ordinary.count(), kept.hot.count()) == (5, 3)
    empty = write_user_log(log.filter("false"), str(tmp_path / "empty"), 2)
    assert empty.by_user(ag.user_features).count() == 0 and empty.split()[0].count() == 0


def test_work_by_user_does_not_shuffle_the_log(spark, log, tmp_path):
    kept = write_user_log(log, str(tmp_path / "log"), 4)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = {
            "features": ag.user_features(kept.ordinary),
            "evaluable": sp.events_of_active_users(kept.ordinary),
            "test": sp.leave_one_out_test(kept.ordinary),
            "train": split_within_buckets(kept.ordinary)[0],
        }
        texts = {n: p._jdf.queryExecution().executedPlan().toString() for n, p in plans.items()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    for text in texts.values():
        assert "Exchange" not in text and "Bucketed: true" in text, text


def test_days_add_up(spark, log, as_rows):
    exact = log.agg(F.count(F.lit(1)), F.count_distinct("visitorid"), F.count_distinct("itemid")).first()
    days = pinned(sk.daily_sketches(log))
    found = sk.kpis_of_days(days).first()
    assert found[0] == exact[0]
    for estimate, truth in zip(found[1:], exact[1:]):
        assert abs(estimate - truth) <= sk.ERROR_BOUND * truth
    halves = [sk.daily_sketches(log.filter(F.col("itemid") % 2 == i)) for i in (0, 1)]
    merged = sk.merge_days(*halves)
    assert as_rows(merged.select("dia", "eventos")) == as_rows(days.select("dia", "eventos"))
    assert sk.kpis_of_days(merged).first() == found


def test_the_error_is_bounded(spark):
    events = spark.range(300_000).select(
        (F.col("id") * 1000).alias("timestamp"), F.col("id").alias("visitorid"), (F.col("id") % 70_000).alias("itemid")
    )
    days = sk.daily_sketches(events)
    assert days.count() == 4
    found = sk.kpis_of_days(days).first()
    assert found.eventos_totales == 300_000
    assert abs(found.usuarios_unicos - 300_000) <= sk.ERROR_BOUND * 300_000
    assert abs(found.productos_distintos - 70_000) <= sk.ERROR_BOUND * 70_000


def test_odd_days(spark, as_rows):
    schema = "timestamp long, visitorid long, itemid long"
    rows = [(None, 1, 1), (-1, None, 2), (0, 1, None), (86_399_999, 1, 5)]
    days = sk.daily_sketches(spark.createDataFrame(rows, schema))
    by_day = sk.kpis_of_days(days, F.col("dia").cast("string"))
    assert as_rows(by_day) == [
        (None, 1, 1, 1), ("1969-12-31", 1, 0, 1), ("1970-01-01", 2, 1, 1),
    ]
    empty = sk.daily_sketches(spark.createDataFrame([], schema))
    assert as_rows(sk.kpis_of_days(empty)) == [(0, 0, 0)]
