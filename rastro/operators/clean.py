"""Cleaning of the raw log and its quality reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rastro.schemas import MAX_REMOVED_RATIO, MIN_TIMESTAMP_RATIO, VALID_EVENTS


def drop_copies(events: DataFrame) -> DataFrame:
    """One row per distinct full row; copies collapse before the shuffle."""
    return events.dropDuplicates()


def _is_complete() -> Column:
    return F.col("itemid").isNotNull() & F.col("visitorid").isNotNull()


def drop_incomplete(events: DataFrame) -> DataFrame:
    """Rows with an item and a user; unlike ``dropna``, this reaches the scan."""
    return events.filter(_is_complete())


def keep_valid_events(events: DataFrame) -> DataFrame:
    return events.filter(F.col("event").isin(VALID_EVENTS))


def item_as_integer(events: DataFrame) -> DataFrame:
    return events.withColumn("itemid", F.col("itemid").cast("bigint"))


def clean_events(events: DataFrame) -> DataFrame:
    """Copies, incomplete rows and unknown events out; item ids as integers.

    Both filters depend on one row only, so the optimizer moves them below the
    deduplication and into the scan.
    """
    return item_as_integer(keep_valid_events(drop_incomplete(drop_copies(events))))


def _is_clean() -> Column:
    return _is_complete() & F.coalesce(F.col("event").isin(VALID_EVENTS), F.lit(False))


def _copies(events: DataFrame) -> DataFrame:
    """Distinct rows with their number of copies and whether they survive."""
    return (
        events.groupBy(*events.columns)
        .agg(F.count(F.lit(1)).alias("copias"))
        .withColumn("queda", _is_clean().cast("bigint"))
    )


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def cleaning_report(events: DataFrame) -> DataFrame:
    """Rows before and after cleaning and the share removed, from one scan."""
    totals = _copies(events).agg(
        F.coalesce(F.sum("copias"), F.lit(0)).alias("filas_antes"),
        F.coalesce(F.sum("queda"), F.lit(0)).alias("filas_despues"),
    )
    removed = F.col("filas_antes") - F.col("filas_despues")
    return totals.select(
        "filas_antes",
        "filas_despues",
        removed.alias("eliminadas"),
        F.round(100 * _ratio(removed, F.col("filas_antes")), 2).alias("pct_eliminadas"),
    )


def quality_report(events: DataFrame) -> DataFrame:
    """Share of distinct timestamps and the alert for false duplicates.

    A log whose timestamps lost precision has few distinct ones and loses many
    rows as copies. Rows are merged to distinct rows first and to distinct
    timestamps second, so a timestamp shared by a third of the log is merged
    before it travels.
    """
    per_timestamp = (
        _copies(events)
        .groupBy("timestamp")
        .agg(F.sum("copias").alias("filas"), F.sum("queda").alias("quedan"))
    )
    totals = per_timestamp.agg(
        F.coalesce(F.sum("filas"), F.lit(0)).alias("filas"),
        F.count(F.lit(1)).alias("ts_unicos"),
        (F.coalesce(F.sum("filas"), F.lit(0)) - F.coalesce(F.sum("quedan"), F.lit(0))).alias(
            "eliminadas"
        ),
    )
    distinct_ratio = _ratio(F.col("ts_unicos"), F.col("filas"))
    removed_ratio = _ratio(F.col("eliminadas"), F.col("filas"))
    return totals.select(
        "filas",
        "ts_unicos",
        "eliminadas",
        F.round(distinct_ratio, 6).alias("proporcion_ts"),
        (
            (F.col("filas") > 0)
            & (distinct_ratio < MIN_TIMESTAMP_RATIO)
            & (removed_ratio > MAX_REMOVED_RATIO)
        ).alias("alerta"),
    )


def clean_category_tree(categories: DataFrame) -> DataFrame:
    """One row per category: the one with the smallest parent, a root first.

    ``min`` of a struct merges copies before the shuffle and, unlike keeping any
    row, gives the same answer under every layout.
    """
    others = [c for c in categories.columns if c != "categoryid"]
    picked = categories.groupBy("categoryid").agg(F.min(F.struct(*others)).alias("fila"))
    return picked.select("categoryid", *[F.col(f"fila.{c}").alias(c) for c in others])
