"""Fixed scores, factors and centres derived from the log.

They stand in for fitted models where results must be checked exactly: ranking,
evaluation and segment reports do not care which model made their input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rastro.functions.running import row_rank
from rastro.operators.recommend import rank_scores
from rastro.operators.segments import label_users
from rastro.operators.split import seen_pairs, unseen_only
from rastro.session import pinned

# Six centres in the scaled feature space, quietest first.
FIXED_CENTERS = [
    [-1.61, -1.57, -1.43, -1.02, -1.11, -1.23],
    [-0.83, -0.79, -0.71, -0.12, -0.93, -0.54],
    [-0.21, -0.17, -0.33, -0.94, 0.41, -0.09],
    [0.13, 0.19, 0.27, 0.88, -0.52, 0.31],
    [0.74, 0.69, 0.81, 0.22, 0.97, 0.43],
    [1.52, 1.47, 1.58, 1.19, 1.07, 1.34],
]


def item_scores(train: DataFrame, score: Column) -> DataFrame:
    """One score per item, the same for all users."""
    return train.groupBy("itemid").agg(score.cast("double").alias("score"))


# Places that every task holds; users who need more of them meet the rest in a join.
HELD_PLACES = 4096


def candidates(train: DataFrame, scores: DataFrame, n: int, held: int = HELD_PLACES) -> DataFrame:
    """Per user the best n + seen(u) items overall: n of them must be unseen.

    All users need the first places, so these travel as one list of bounded length. Only users
    who have seen very much need places beyond it; their rows are shuffled by place.
    """
    ranked = pinned(row_rank(scores, [], [F.desc("score"), F.asc("itemid")], "place"))
    counts = seen_pairs(train).groupBy("visitorid").agg(F.count(F.lit(1)).alias("n_seen"))
    wanted = counts.withColumn("_last", F.col("n_seen") + n)
    first = ranked.filter(F.col("place") <= held).agg(
        F.sort_array(F.collect_list(F.struct("place", "itemid", "score")))
    )
    common = wanted.withColumn("_first", first.scalar()).select(
        "visitorid",
        F.inline(F.slice("_first", F.lit(1), F.least(F.col("_last"), F.lit(held)).cast("int"))),
    )
    beyond = wanted.filter(F.col("_last") > held).select(
        "visitorid",
        F.explode(F.sequence(F.lit(held + 1).cast("bigint"), F.col("_last"))).alias("place"),
    )
    # An exploded table is larger than the planner thinks.
    rest = beyond.hint("merge").join(ranked.filter(F.col("place") > held), "place")
    return common.select("visitorid", "itemid", "score").unionByName(
        rest.select("visitorid", "itemid", "score")
    )


def fixed_recommendations(train: DataFrame, score: Column, n: int = 10) -> DataFrame:
    """Top-n unseen items per user under a score per item."""
    pool = candidates(train, item_scores(train, score), n)
    unseen = unseen_only(pool, seen_pairs(train))
    return rank_scores(unseen, n, "visitorid", "itemid")


def by_weight() -> Column:
    return F.sum("peso_implicito")


def by_events() -> Column:
    return F.count(F.lit(1))


def fixed_segments(features: DataFrame) -> DataFrame:
    return label_users(features, FIXED_CENTERS)


def event_factors(cells: DataFrame, key: str) -> DataFrame:
    """(id, features): how often each event occurred; whole numbers, so that
    products are exact."""
    counts = [F.count_if(F.col("event") == e) for e in ("view", "addtocart", "transaction")]
    return cells.groupBy(F.col(key).alias("id")).agg(
        F.array(*[c.cast("double") for c in counts]).alias("features")
    )
