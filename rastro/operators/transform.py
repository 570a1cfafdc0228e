"""Columns derived from a clean log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rastro.functions.columns import implicit_weight, iso_weekday, utc_datetime, utc_hour
from rastro.schemas import FEATURE_COLUMNS


def add_datetime(events: DataFrame) -> DataFrame:
    return events.withColumn("fecha", utc_datetime(F.col("timestamp")))


def add_weight(events: DataFrame) -> DataFrame:
    return events.withColumn("peso_implicito", implicit_weight(F.col("event")))


def add_hour_weekday(events: DataFrame) -> DataFrame:
    return events.withColumns(
        {
            "hora_del_dia": utc_hour(F.col("timestamp")),
            "dia_semana": iso_weekday(F.col("timestamp")),
        }
    )


def transform_events(events: DataFrame) -> DataFrame:
    """Datetime, weight, hour and ISO weekday in one projection."""
    return add_hour_weekday(add_weight(add_datetime(events)))


def segment_names(k: int = 6) -> dict[int, str]:
    """Names of segments that are labelled by activity, the quietest 0."""
    ends = {0: "el menos activo", k - 1: "el más activo"}
    return {label: f"Segmento {label} — {ends.get(label, 'actividad intermedia')}" for label in range(k)}


def name_clusters(df: DataFrame, names: dict[int, str] | None = None, k: int = 6) -> DataFrame:
    """Cluster id → label; an id without a label gives null.

    Without ``names`` the k labels are those of fitted segments, by activity.
    """
    names = segment_names(k) if names is None else names
    pairs = [F.lit(part) for item in names.items() for part in item]
    return df.withColumn("cluster_nombre", F.try_element_at(F.create_map(*pairs), F.col("cluster")))


def log_features(features: DataFrame, columns: list[str] | None = None) -> DataFrame:
    columns = FEATURE_COLUMNS if columns is None else columns
    return features.withColumns({c: F.log1p(F.col(c)) for c in columns})
