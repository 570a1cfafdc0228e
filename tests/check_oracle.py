"""Run registered queries against their SQL: python tests/check_oracle.py [names…]."""

from __future__ import annotations

import os
import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def normalized(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for column in frame.columns:
        values = frame[column]
        if str(values.dtype).startswith("datetime"):
            frame[column] = values.astype("datetime64[us]")
        elif str(values.dtype) in ("object", "str", "string"):
            frame[column] = values.astype(object).where(values.notna(), None)
    return frame.sort_values(list(frame.columns), na_position="first").reset_index(drop=True)


def type_of(values: pd.Series) -> str:
    """Kind and width; pandas has more than one form for integers with nulls."""
    if values.isna().any() and values.dtype.kind in "if":
        return "number with nulls"
    return f"{values.dtype.kind}{values.dtype.itemsize}"


def differences(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    """None when both hold the same rows, else what differs first."""
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} / {sorted(sql_frame.columns)}"
    if len(spark_frame) != len(sql_frame):
        return f"rows {len(spark_frame)} / {len(sql_frame)}"
    left, right = normalized(spark_frame), normalized(sql_frame)
    for column in left.columns:
        if type_of(left[column]) != type_of(right[column]):
            return f"type of {column}: {left[column].dtype} / {right[column].dtype}"
        same = (left[column] == right[column]) | (left[column].isna() & right[column].isna())
        if not same.all():
            at = same.idxmin()
            return f"{column}: {left[column][at]!r} / {right[column][at]!r} ({(~same).sum()} rows)"
    return None


def main(names: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from rastro.session import build_session

    sf_dir = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")
    spark = build_session(
        "check",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered, sql = queries(), oracle_sql()
    connection, failed = duck(sf_dir), 0
    for name in names or list(registered):
        start = time.perf_counter()
        try:
            result = registered[name](spark, sf_dir).toPandas()
            taken = time.perf_counter() - start
            if name in sql:
                outcome = differences(result, connection.execute(sql[name]).df())
            else:
                outcome = None if len(result) else "no rows"
        except Exception as error:  # noqa: BLE001 - report and go on
            taken, outcome = time.perf_counter() - start, f"{type(error).__name__}: {str(error)[:700]}"
            result = []
        failed += outcome is not None
        label = "ok  " if outcome is None else "FAIL"
        kind = "sql " if name in sql else "rows"
        print(f"{label} {kind} {name:24s} {len(result):7d} rows {taken:6.2f} s {outcome or ''}", flush=True)
    print(f"{failed} failed; without SQL: {sorted(set(registered) - set(sql))}")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
