"""Held-out rows by key, and bounded samples of rows by hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(key: str, parts: int, part: int) -> Column:
    """crc32 of the key as text, modulo ``parts``, is ``part``; false for a null key."""
    crc = F.crc32(F.col(key).cast("string").cast("binary"))
    return F.coalesce(crc % parts == part, F.lit(False))


def sampled(df: DataFrame, group: str, key: str, rows: int) -> DataFrame:
    """About ``rows`` rows of each group, chosen by a hash of the key; all, if it has fewer.

    The share of each group follows from its size, so no group is gathered.
    """
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias("_size"))
    draw = F.pmod(F.xxhash64(F.lit("sample"), F.col(key)), F.lit(1 << 30)) / float(1 << 30)
    return (
        df.join(sizes, group)
        .filter(draw * F.col("_size") < rows)
        .drop("_size")
    )
