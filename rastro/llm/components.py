"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rastro.llm.common import pinned


def components(links: DataFrame) -> DataFrame:
    """(v, component) for every end of a link (a, b): the smallest v reachable.

    Stars: in turn, every vertex ties its larger neighbours, and then its smaller ones, to the
    least of them, until nothing changes. The number of rounds grows with the logarithm of the
    longest path; every round is groupings and joins of links, written to the shared folder. A
    vertex with very many links is pre-aggregated, and split by the adaptive join.
    """
    edges = pinned(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    )
    before = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            break
        before = state
        edges = pinned(_small(_large(edges)))
    return edges.select(F.col("a").alias("v"), F.col("b").alias("component")).union(
        edges.select("b", "b").distinct()
    )


def _large(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    tied = both.join(least, "a").filter("b > a")
    return tied.select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    tied = edges.join(least, "a")
    return (
        tied.filter("b <> m")
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .union(least.select("a", F.col("m").alias("b")))
        .distinct()
    )
