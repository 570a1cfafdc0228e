"""A log kept by user: what is asked by user afterwards needs no shuffle of it.

Ordinary users are in a bucketed table, all rows of a user in one bucket. Users with very many
rows would make one bucket, and so one task, as large as themselves. They are kept beside it,
spread over all files, as are rows without a user, and go through the ordinary shuffles.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rastro.functions.running import HOT_ROWS
from rastro.operators.split import leave_one_out_test, split_events
from rastro.schemas import ROW_ORDER
from rastro.session import checked_broadcast, pinned

USER = "visitorid"


@dataclass(frozen=True)
class UserLog:
    """Both parts of a log; no user is in both."""

    ordinary: DataFrame
    hot: DataFrame

    def by_user(self, operator: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """``operator``'s rows of both parts, for operators whose rows belong to one user."""
        return operator(self.ordinary).unionByName(operator(self.hot))

    def split(self, min_events: int = 2) -> tuple[DataFrame, DataFrame]:
        """(train, test) of a cleaned log, as ``split_events`` gives them."""
        train, test = split_within_buckets(self.ordinary, min_events)
        hot_train, hot_test = split_events(self.hot, min_events)
        return train.unionByName(hot_train), test.unionByName(hot_test)


def split_within_buckets(events: DataFrame, min_events: int = 2) -> tuple[DataFrame, DataFrame]:
    """(train, test) of the bucketed part: a user's rows and newest event are in one bucket, so
    the newest one is joined by user alone, and not as a whole row."""
    test = leave_one_out_test(events, min_events)
    newest = test.select(USER, F.struct(*ROW_ORDER).alias("_newest_row"))
    train = events.join(newest, USER, "left").filter(~F.struct(*ROW_ORDER).eqNullSafe(F.col("_newest_row")))
    return train.select(*events.columns), test


def write_user_log(events: DataFrame, path: str, buckets: int, hot_rows: int = HOT_ROWS) -> UserLog:
    """Writes ``events`` below ``path``, which must be new. Choose ``buckets`` so that a bucket
    fits a task, some 200 MB. Users with more than ``hot_rows`` rows are hot."""
    spark = events.sparkSession
    path = path.rstrip("/")
    counts = events.filter(F.col(USER).isNotNull()).groupBy(USER).agg(F.count(F.lit(1)).alias("n"))
    hot_users = pinned(counts.filter(F.col("n") > hot_rows).select(USER))
    named = checked_broadcast(hot_users, hot_users.count())
    hot = events.join(named, USER, "left_semi").unionByName(events.filter(F.col(USER).isNull()))
    hot.select(*events.columns).write.parquet(f"{path}/hot")
    ordinary = events.filter(F.col(USER).isNotNull()).join(named, USER, "left_anti")
    # One file for each bucket.
    (
        ordinary.select(*events.columns)
        .repartition(buckets, USER)
        .write.bucketBy(buckets, USER)
        .sortBy(USER)
        .option("path", f"{path}/ordinary")
        .saveAsTable(_new_name())
    )
    about = spark.range(1).select(F.lit(buckets).alias("buckets"), F.lit(events.schema.json()).alias("columns"))
    about.coalesce(1).write.parquet(f"{path}/about")
    return open_user_log(spark, path)


def open_user_log(spark: SparkSession, path: str) -> UserLog:
    """A written log, in any session; its buckets are known to the session's catalog afterwards."""
    import json

    path = path.rstrip("/")
    about = spark.read.parquet(f"{path}/about").first()
    schema = StructType.fromJson(json.loads(about["columns"]))
    name = _new_name()
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{USER}`) SORTED BY (`{USER}`) "
        f"INTO {about['buckets']} BUCKETS LOCATION '{path}/ordinary'"
    )
    return UserLog(spark.table(name), spark.read.schema(schema).parquet(f"{path}/hot"))


def _new_name() -> str:
    return f"user_log_{uuid.uuid4().hex}"
