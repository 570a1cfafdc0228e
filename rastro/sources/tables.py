"""Parquet tables, prefixes, partition counts and synthetic feature tables."""

from __future__ import annotations

from math import pi

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rastro.functions.columns import hash_int
from rastro.functions.running import first_rows

# The whole range of hash_int: 60 bits.
HASH_RANGE = float(2**60)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table written by one of the sinks."""
    return spark.read.parquet(path)


def subset(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """The first n rows in a fixed order, for runs on growing input."""
    return first_rows(df, [F.col(c).asc() for c in order], n)


def partition_count(df: DataFrame) -> DataFrame:
    """Non-empty partitions of the scan, with the smallest and largest row count."""
    per_partition = df.groupBy(F.spark_partition_id().alias("particion")).count()
    return per_partition.agg(
        F.count(F.lit(1)).alias("particiones"),
        F.sum("count").alias("filas"),
        F.min("count").alias("min_filas"),
        F.max("count").alias("max_filas"),
    )


def partition_count_for_block(
    spark: SparkSession, path: str, reader: str, block_bytes: int
) -> DataFrame:
    """``partition_count`` of a file source cut into blocks of a given size."""
    # A session of its own, so that the setting reaches this scan and no other.
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", str(block_bytes))
    return partition_count(session.read.format(reader).load(path))


def synthetic_features(
    keys: DataFrame,
    key: str,
    n_columns: int = 6,
    seed: int = 42,
    mean: float = 1.5,
    sigma: float = 1.2,
) -> DataFrame:
    """Lognormal columns f0…, one row per key.

    Values depend on seed, key and column alone (Box-Muller on two md5 draws),
    so they do not change with the layout of the data.
    """

    def uniform(column: int, part: int):
        draw = hash_int(F.lit(seed), F.col(key), F.lit(column), F.lit(part))
        return (draw.cast("double") + 0.5) / HASH_RANGE

    features = []
    for j in range(n_columns):
        normal = F.sqrt(-2.0 * F.log(uniform(j, 0))) * F.cos(2.0 * pi * uniform(j, 1))
        features.append(F.exp(F.lit(mean) + F.lit(sigma) * normal).alias(f"f{j}"))
    return keys.select(key, *features)
