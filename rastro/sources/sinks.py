"""Writers. Each writes a folder in parallel and returns its path."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_events(df: DataFrame, path: str) -> str:
    """Transformed events, one folder per weekday.

    A plain shuffle on the weekday would put the log into seven tasks, and none
    at all would leave seven small files per task. Rebalancing gathers each
    weekday and cuts it into parts of the advisory size.
    """
    balanced = df.hint("rebalance", F.col("dia_semana"))
    balanced.write.mode("errorifexists").partitionBy("dia_semana").parquet(path)
    return path


def write_table(df: DataFrame, path: str) -> str:
    df.write.mode("errorifexists").parquet(path)
    return path


def write_csv(
    df: DataFrame, path: str, separator: str = ",", mode: str = "errorifexists"
) -> str:
    df.write.mode(mode).option("header", True).option("sep", separator).csv(path)
    return path


def write_json(df: DataFrame, path: str, field: str | None = None) -> str:
    """JSON lines; with ``field`` every row is nested below that name."""
    if field:
        df = df.select(F.struct(*df.columns).alias(field))
    df.write.mode("errorifexists").json(path)
    return path
