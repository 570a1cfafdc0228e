"""Implicit ALS, top-N without seen items, and scores of given pairs."""

from __future__ import annotations

from math import ceil

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rastro.functions.columns import dot
from rastro.operators.implicit import fit_scaled
from rastro.operators.split import sample_users
from rastro.operators.topn import RankIndex
from rastro.session import pinned, shared_folder

MIN_BLOCKS = 10
MAX_INDEX = 2**31 - 1
CELLS_PER_BLOCK = 1_000_000


def fit_als(
    cells: DataFrame,
    factors: int = 64,
    regularization: float = 0.01,
    iterations: int = 15,
    seed: int = 42,
    alpha: float = 1.0,
    blocks: int | None = None,
) -> ALSModel:
    """Implicit-feedback factors of (u_idx, i_idx, peso), a pinned table.

    Objective, first rows and order of the half steps are those of Spark's ALS, and so is the
    model. Its half steps are not run by it: each shuffles both sides' rows to all blocks that
    need them and leaves the files for later. ``implicit.fit_scaled`` solves the same equations
    and writes every half step, so a lost executor does not repeat the fit.
    """
    spark = cells.sparkSession
    shared_folder(spark)
    number, largest, bad = cells.agg(
        F.count(F.lit(1)),
        F.greatest(F.max("u_idx"), F.max("i_idx")),
        F.count_if(F.col("u_idx").isNull() | F.col("i_idx").isNull() | F.col("peso").isNull() | F.isnan("peso")),
    ).first()
    if largest is not None and largest > MAX_INDEX:
        raise ValueError(f"index {largest}: the model takes indices up to {MAX_INDEX}")
    if bad:
        raise ValueError(f"{bad} cells without index or weight")
    # Blocks of the first draw, whose number follows the data, not the cores.
    draws = blocks or max(MIN_BLOCKS, ceil(number / CELLS_PER_BLOCK))
    als = ALS(
        rank=factors,
        maxIter=0,
        regParam=regularization,
        implicitPrefs=True,
        alpha=alpha,
        nonnegative=False,
        userCol="u_idx",
        itemCol="i_idx",
        ratingCol="peso",
        seed=seed,
        numUserBlocks=draws,
        numItemBlocks=draws,
        coldStartStrategy="drop",
    )
    # The users' first rows depend on their indices and on the number of blocks alone.
    users = cells.select(F.col("u_idx").cast("int")).distinct()
    kept = set(spark.sparkContext._jsc.getPersistentRDDs())
    start = als.fit(
        users.select("u_idx", F.pmod("u_idx", F.lit(draws)).alias("i_idx"), F.lit(1.0).cast("float").alias("peso"))
    )
    first = pinned(start.userFactors)
    for number, rdd in dict(spark.sparkContext._jsc.getPersistentRDDs()).items():
        if number not in kept:
            rdd.unpersist()
    found = fit_scaled(cells, first, factors, regularization, iterations, alpha, blocks)
    sides = [t.withColumn("id", F.col("id").cast("int"))._jdf for t in (found.userFactors, found.itemFactors)]
    model = spark._jvm.org.apache.spark.ml.recommendation.ALSModel(start.uid, factors, *sides)
    return als._copyValues(ALSModel(model))


def rank_index(model: ALSModel, users: DataFrame, items: DataFrame, seen: DataFrame) -> RankIndex:
    """The model's factors with the ids of users (visitorid, u_idx) and items (itemid, i_idx), and
    the seen pairs, laid out for ``RankIndex.lists`` and ``RankIndex.places``."""
    left = model.userFactors.select(F.col("id").cast("bigint").alias("u_idx"), "features")
    right = model.itemFactors.select(F.col("id").cast("bigint").alias("i_idx"), "features")
    return RankIndex(users.join(left, "u_idx"), items.join(right, "i_idx"), seen)


def top_n_unseen(model: ALSModel, users: DataFrame, seen: DataFrame, n: int = 10) -> DataFrame:
    """(u_idx, rank, i_idx, score): the n best items each user has not seen, the lower index
    first on a tie."""
    left = model.userFactors.select(F.col("id").cast("bigint").alias("u_idx"), "features")
    right = model.itemFactors.select(F.col("id").cast("bigint").alias("i_idx"), "features")
    index = RankIndex(
        left.withColumn("visitorid", F.col("u_idx")), right.withColumn("itemid", F.col("i_idx")), seen
    )
    lists = index.lists(users.select(F.col("u_idx").alias("visitorid")), n)
    return lists.select(F.col("visitorid").alias("u_idx"), "rank", F.col("itemid").alias("i_idx"), "score")


def rank_scores(
    scored: DataFrame, n: int, user: str = "u_idx", item: str = "i_idx", score: str = "score"
) -> DataFrame:
    """The n best items per user with their rank; the lower item wins a tie.

    Each task keeps n rows per user before the shuffle, so a user with very many
    scored items does not fill one task.
    """
    order = Window.partitionBy(user).orderBy(F.desc(score), F.asc(item))
    ranked = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)
    return ranked.select(user, "rank", item, score)


def popular_items(cells: DataFrame, n: int = 10) -> DataFrame:
    """(rank, itemid, score): the n items with the greatest summed weight, the lower id first
    on a tie."""
    weights = cells.groupBy("itemid").agg(F.sum("peso").cast("double").alias("score"))
    best = weights.orderBy(F.desc("score"), "itemid").limit(n)
    # n rows.
    order = Window.orderBy(F.desc("score"), "itemid")
    return best.select(F.row_number().over(order).alias("rank"), "itemid", "score")


def popular_for_new(visitors: DataFrame, known: DataFrame, popular: DataFrame) -> DataFrame:
    """The popular list, n rows, for every visitor without one of their own."""
    new = visitors.select("visitorid").distinct().join(known.select("visitorid"), "visitorid", "left_anti")
    whole = popular.agg(F.sort_array(F.collect_list(F.struct("rank", "itemid", "score"))))
    return new.withColumn("_list", whole.scalar()).select("visitorid", F.inline("_list"))


def recommendations_of(recommendations: DataFrame, visitorid: int) -> DataFrame:
    """One user's list, best first."""
    return recommendations.filter(F.col("visitorid") == visitorid).orderBy("rank")


def users_with_recommendations(recommendations: DataFrame) -> DataFrame:
    return recommendations.select("visitorid").distinct().orderBy("visitorid")


def sample_recommendations(
    index: RankIndex, users: DataFrame, n_users: int = 100, n: int = 10, seed: int = 42
) -> DataFrame:
    """Long-format lists for a seeded sample of users."""
    return index.lists(sample_users(users, n_users, seed), n)


def score_pairs(
    pairs: DataFrame, user_factors: DataFrame, item_factors: DataFrame
) -> DataFrame:
    """Add ``score``, the inner product of both factors, to (u_idx, i_idx) rows.

    Factor tables are (id, features). A pair without factors gets no row.
    """
    left = user_factors.select(F.col("id").cast("bigint").alias("u_idx"), F.col("features").alias("_u"))
    right = item_factors.select(F.col("id").cast("bigint").alias("i_idx"), F.col("features").alias("_i"))
    joined = pairs.join(left, "u_idx").join(right, "i_idx")
    return joined.withColumn("score", dot(F.col("_u"), F.col("_i"))).select(*pairs.columns, "score")
