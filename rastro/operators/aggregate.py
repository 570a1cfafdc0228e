"""Aggregates over clean events, interactions and segments.

All of them merge rows inside each task before the shuffle. Distinct counts are
planned over (key, value) first, so a hot key is spread by its values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rastro.schemas import FEATURE_COLUMNS

PROFILE_COLUMNS = [c for c in FEATURE_COLUMNS if c != "peso_total"]


def user_features(events: DataFrame) -> DataFrame:
    """One row per user: activity, distinct items, weight and counts by event.

    The log is merged to (user, item) once; the number of items is then the
    number of merged rows and no distinct count is needed.
    """

    def times(name: str):
        return F.count_if(F.col("event") == name)

    pairs = events.groupBy("visitorid", "itemid").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("peso_implicito").alias("peso"),
        times("view").alias("v"),
        times("addtocart").alias("a"),
        times("transaction").alias("t"),
    )
    return pairs.groupBy("visitorid").agg(
        F.sum("n").alias("total_interacciones"),
        F.count(F.lit(1)).alias("productos_distintos"),
        F.sum("peso").alias("peso_total"),
        F.sum("v").alias("views"),
        F.sum("a").alias("carritos"),
        F.sum("t").alias("compras"),
    )


def interactions(events: DataFrame) -> DataFrame:
    """Summed weight per (user, item): the non-zero cells of the matrix."""
    return events.groupBy("visitorid", "itemid").agg(F.sum("peso_implicito").alias("peso"))


def matrix_density(cells: DataFrame) -> DataFrame:
    """Users, items, non-zero cells and the share of the matrix they fill."""
    # Two groupings and not two distinct counts at once, which would copy every cell.
    users = cells.groupBy("visitorid").agg(F.count(F.lit(1)).alias("n"))
    items = cells.groupBy("itemid").agg(F.lit(1).alias("n"))
    totals = users.agg(
        F.count("visitorid").alias("usuarios"), F.coalesce(F.sum("n"), F.lit(0)).alias("nnz")
    ).select(
        "usuarios", items.agg(F.count("itemid")).scalar().alias("productos"), "nnz"
    )
    whole = F.col("usuarios").cast("double") * F.col("productos")
    density = F.coalesce(F.try_divide(100.0 * F.col("nnz"), whole), F.lit(0.0))
    return totals.withColumn("densidad_pct", F.round(density, 6))


def event_counts(events: DataFrame) -> DataFrame:
    counts = events.groupBy("event").agg(F.count(F.lit(1)).alias("cantidad"))
    return counts.orderBy(F.desc("cantidad"), "event")


def hourly_activity(events: DataFrame) -> DataFrame:
    counts = events.groupBy("hora_del_dia").agg(F.count(F.lit(1)).alias("interacciones"))
    return counts.orderBy("hora_del_dia")


def top_products(events: DataFrame, n: int = 15) -> DataFrame:
    counts = events.groupBy("itemid").agg(F.count(F.lit(1)).alias("interacciones"))
    return counts.orderBy(F.desc("interacciones"), "itemid").limit(n)


def kpis(events: DataFrame, segments: DataFrame) -> DataFrame:
    """Events, users, distinct items and clusters in one row."""
    users = segments.agg(F.struct(F.count(F.lit(1)).alias("n"), F.count_distinct("cluster").alias("k")))
    counted = events.agg(
        F.count(F.lit(1)).alias("eventos_totales"),
        F.count_distinct("itemid").alias("productos_distintos"),
    )
    return counted.withColumn("_u", users.scalar()).select(
        "eventos_totales",
        F.col("_u.n").alias("usuarios_unicos"),
        "productos_distintos",
        F.col("_u.k").alias("clusters"),
    )


def cluster_sizes(segments: DataFrame) -> DataFrame:
    sizes = segments.groupBy("cluster").agg(F.count(F.lit(1)).alias("usuarios"))
    return sizes.orderBy("cluster")


def cluster_profile(segments: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Mean of every feature per cluster."""
    columns = FEATURE_COLUMNS if columns is None else columns
    profile = segments.groupBy("cluster").agg(*[F.avg(c).alias(c) for c in columns])
    return profile.orderBy("cluster")


def scaled_profile(
    profile: DataFrame, columns: list[str] | None = None, outlier: int | None = None
) -> DataFrame:
    """Profiles of the ordinary clusters, each column moved to 0…1.

    The outlier cluster is left out, as it would flatten the others: the most active one, which
    has the highest label, unless another is named. A column without spread gives 0. The input has one row per cluster, so one window may
    hold all of it.
    """
    columns = PROFILE_COLUMNS if columns is None else columns
    every = Window.partitionBy()
    left_out = F.max("cluster").over(every) if outlier is None else F.lit(outlier)
    ordinary = profile.withColumn("_out", left_out).filter("cluster <> _out")

    def scaled(c: str):
        low, high = F.min(c).over(every), F.max(c).over(every)
        return F.coalesce(F.try_divide(F.col(c) - low, high - low), F.lit(0.0)).alias(c)

    return ordinary.select("cluster", *[scaled(c) for c in columns])


def hits_with_segments(hits: DataFrame, segments: DataFrame) -> DataFrame:
    """Per-user hits with the user's cluster, null where there is none."""
    return hits.join(segments.select("visitorid", "cluster"), "visitorid", "left")


def hit_rate_by_cluster(hits: DataFrame, segments: DataFrame, k: int = 10) -> DataFrame:
    grouped = hits_with_segments(hits, segments).groupBy("cluster")
    return grouped.agg(
        F.avg("hit").alias(f"hit_rate@{k}"),
        F.count(F.lit(1)).alias("n_usuarios_evaluados"),
    ).orderBy("cluster")
