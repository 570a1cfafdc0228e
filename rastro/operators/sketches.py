"""Counts and distinct-count sketches by day, so that a dashboard reads days and not the log.

Sketches are HyperLogLog: of a bounded size, and two of them merge into the one of both their
inputs. So days add up to any period, and late rows of a day are added without its old ones.
"""

from __future__ import annotations

from math import sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Binary logarithm of a sketch's cells: 16 KB, and less while it has seen few values.
CELLS_LOG2 = 14
#: Four standard errors of a sketch with so many cells: 3.3 %.
ERROR_BOUND = 4 * 1.04 / sqrt(2**CELLS_LOG2)

DAY_MILLIS = 86_400_000
SKETCHES = ["usuarios_hll", "productos_hll"]


def daily_sketches(events: DataFrame, cells_log2: int = CELLS_LOG2) -> DataFrame:
    """dia, eventos and the sketches of users and items of each UTC day.

    Each task sends one row for each of its days. Events without a timestamp are in a row of
    their own, whose day is null; missing users and items are not counted.
    """
    day = F.date_from_unix_date(F.floor(F.col("timestamp") / DAY_MILLIS).cast("int"))
    return events.groupBy(day.alias("dia")).agg(
        F.count(F.lit(1)).alias("eventos"),
        F.hll_sketch_agg("visitorid", cells_log2).alias("usuarios_hll"),
        F.hll_sketch_agg("itemid", cells_log2).alias("productos_hll"),
    )


def merge_days(*days: DataFrame) -> DataFrame:
    """Kept days and new ones: rows of the same day become one. Loads must not overlap in
    events, which are added; distinct users and items would not mind."""
    every = days[0]
    for more in days[1:]:
        every = every.unionByName(more)
    merged = [F.hll_union_agg(c).alias(c) for c in SKETCHES]
    return every.groupBy("dia").agg(F.sum("eventos").alias("eventos"), *merged)


def kpis_of_days(days: DataFrame, period: Column | None = None) -> DataFrame:
    """Events, and estimates of distinct users and items, of all days or of each ``period``.

    Estimates are within ``ERROR_BOUND`` of the truth but for one in some ten thousand. No day
    gives zeros.
    """
    grouped = days.groupBy() if period is None else days.groupBy(period.alias("periodo"))

    def estimate(sketch: str) -> Column:
        return F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(sketch)), F.lit(0))

    return grouped.agg(
        F.coalesce(F.sum("eventos"), F.lit(0)).alias("eventos_totales"),
        estimate("usuarios_hll").cast("bigint").alias("usuarios_unicos"),
        estimate("productos_hll").cast("bigint").alias("productos_distintos"),
    )
