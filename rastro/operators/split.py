"""Recency ranks, leave-one-out split, semi and anti joins, samples of users."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rastro.functions.running import HOT_ROWS, first_rows, row_rank
from rastro.schemas import ROW_ORDER


def newest_first() -> list[Column]:
    """Total order of one user's distinct events; a missing transaction is last."""
    return [F.col(c).desc_nulls_last() for c in ROW_ORDER]


def recency_rank(events: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``rank_reciente``: 1 for a user's newest event, without gaps or ties."""
    return row_rank(events, ["visitorid"], newest_first(), "rank_reciente", hot_rows)


def active_users(events: DataFrame, min_events: int = 2) -> DataFrame:
    counts = events.groupBy("visitorid").agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") >= min_events).select("visitorid")


def events_of_active_users(events: DataFrame, min_events: int = 2) -> DataFrame:
    """Events of the users that have at least ``min_events``.

    A semi join instead of a count window: no task has to hold all the events
    of one user.
    """
    active = active_users(events, min_events)
    return events.join(active, "visitorid", "left_semi").select(*events.columns)


def leave_one_out_test(events: DataFrame, min_events: int = 2) -> DataFrame:
    """The newest event of every user with at least ``min_events``.

    It is the greatest row in ``ROW_ORDER``, an aggregate that merges inside
    each task; null sorts lowest in a struct, which is last when newest is first.
    """
    rest = [c for c in events.columns if c not in ROW_ORDER and c != "visitorid"]
    newest = events.groupBy("visitorid").agg(
        F.max(F.struct(*ROW_ORDER, *rest)).alias("fila"),
        F.count(F.lit(1)).alias("n"),
    )
    kept = newest.filter(F.col("n") >= min_events)
    fields = [
        F.col("visitorid") if c == "visitorid" else F.col(f"fila.{c}").alias(c)
        for c in events.columns
    ]
    return kept.select(*fields)


def leave_one_out_train(
    events: DataFrame, test: DataFrame, distinct_rows: bool = True
) -> DataFrame:
    """All events that are not the test event of their user.

    The anti join is on the whole row, so a user with very many events is spread
    over all tasks. A cleaned log has distinct rows; for any other log pass
    ``distinct_rows=False``: of several copies of a test row only one leaves.
    """
    same_row = reduce(
        lambda a, b: a & b,
        [F.col(f"e.{c}").eqNullSafe(F.col(f"t.{c}")) for c in ("visitorid", *ROW_ORDER)],
    )
    train = events.alias("e").join(test.alias("t"), same_row, "left_anti")
    if distinct_rows:
        return train
    copies = (
        events.alias("e")
        .join(test.alias("t"), same_row, "left_semi")
        .groupBy(*events.columns)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > 1)
    )
    again = copies.select(
        *events.columns, F.explode(F.sequence(F.lit(2).cast("bigint"), F.col("_n"))).alias("_i")
    )
    return train.unionByName(again.drop("_i"))


def split_events(
    events: DataFrame, min_events: int = 2, distinct_rows: bool = True
) -> tuple[DataFrame, DataFrame]:
    """(train, test) of a cleaned log; of one with copies, pass ``distinct_rows=False``."""
    test = leave_one_out_test(events, min_events)
    return leave_one_out_train(events, test, distinct_rows), test


def known_in_train(test: DataFrame, train: DataFrame) -> DataFrame:
    """Test rows whose user and item both occur in train."""
    users = train.select("visitorid").distinct()
    items = train.select("itemid").distinct()
    return test.join(users, "visitorid", "left_semi").join(items, "itemid", "left_semi").select(
        *test.columns
    )


def seen_pairs(events: DataFrame) -> DataFrame:
    """Distinct (user, item) pairs: the items each user has seen."""
    return events.select("visitorid", "itemid").distinct()


def unseen_only(
    candidates: DataFrame, seen: DataFrame, keys: tuple[str, str] = ("visitorid", "itemid")
) -> DataFrame:
    """Candidates without the pairs that were already seen."""
    return candidates.join(seen.select(*keys), list(keys), "left_anti").select(*candidates.columns)


def limit_test_users(test: DataFrame, n: int) -> DataFrame:
    """The n test users with the lowest id."""
    return first_rows(test, [F.col("visitorid").asc()], n)


def sample_users(users: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """n distinct users, drawn without replacement by a seeded hash of the id."""
    distinct = users.select("visitorid").distinct()
    drawn = distinct.withColumn("_h", F.md5(F.concat_ws(":", F.lit(str(seed)), "visitorid")))
    return first_rows(drawn, [F.col("_h"), F.col("visitorid")], n).drop("_h")

