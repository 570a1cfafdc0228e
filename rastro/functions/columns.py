"""Column expressions shared by the operators. All of them stay in the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from rastro.schemas import DEFAULT_WEIGHT, EVENT_WEIGHTS

MS_PER_HOUR = 3_600_000
MS_PER_DAY = 86_400_000


def separator_of(line: Column) -> Column:
    """``;`` when the line holds more semicolons than commas, else ``,``."""

    def occurrences(mark: str) -> Column:
        return F.length(line) - F.length(F.replace(line, F.lit(mark), F.lit("")))

    return F.when(occurrences(";") > occurrences(","), F.lit(";")).otherwise(F.lit(","))


def spreadsheet_millis(text: Column) -> Column:
    """``1,43322E+12`` → 1433220000000; text that is no number becomes null."""
    return F.replace(text, F.lit(","), F.lit(".")).try_cast("double").cast("bigint")


def implicit_weight(event: Column) -> Column:
    weight = F.lit(DEFAULT_WEIGHT)
    for name, value in EVENT_WEIGHTS.items():
        weight = F.when(event == name, F.lit(value)).otherwise(weight)
    return weight.cast("int")


def utc_datetime(millis: Column) -> Column:
    """Epoch milliseconds → zone-less datetime, whatever the session zone is."""
    epoch = F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    return epoch + millis * F.expr("interval '0.001' second")


def utc_hour(millis: Column) -> Column:
    return F.floor(F.pmod(millis, F.lit(MS_PER_DAY)) / MS_PER_HOUR).cast("int")


def iso_weekday(millis: Column) -> Column:
    """Monday = 1 … Sunday = 7; day 0 of the epoch was a Thursday."""
    day = (millis - F.pmod(millis, F.lit(MS_PER_DAY))) / MS_PER_DAY
    return (F.pmod(day.cast("bigint") + 3, F.lit(7)) + 1).cast("int")


def hash_int(*parts: Column) -> Column:
    """60-bit integer from the md5 of the parts, the same in any SQL engine."""
    text = F.concat_ws(":", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def round_even(value: Column, digits: int) -> Column:
    """Rounding of table columns: scale, nearest whole number (even on a tie), scale back."""
    scale = float(10**digits)
    return F.rint(value * scale) / scale


def dot(left: Column, right: Column) -> Column:
    """Inner product of two float or double arrays."""
    products = F.zip_with(left, right, lambda a, b: a.cast("double") * b.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def squared_distance(columns: list[Column], center: list[float]) -> Column:
    parts = [(c - F.lit(float(v))) * (c - F.lit(float(v))) for c, v in zip(columns, center)]
    return reduce(lambda a, b: a + b, parts)


def hit(rank: Column, k: int) -> Column:
    """1 when the relevant item is within the first k, else 0 (a null rank too)."""
    return F.when(rank <= k, 1).otherwise(0)


def average_precision(rank: Column, k: int) -> Column:
    return F.when(rank <= k, 1.0 / rank).otherwise(0.0)


def ndcg(rank: Column, k: int) -> Column:
    return F.when(rank <= k, 1.0 / F.log2(rank + 1)).otherwise(0.0)
