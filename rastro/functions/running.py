"""Running totals and ranks that survive groups of any size.

A window sorts each group inside one task. That is right for groups of ordinary
size, and fatal for one that holds a third of the table. Groups above
``HOT_ROWS`` are therefore range-partitioned on their whole sort key, so they
spread over many tasks, and every slice adds the total of the slices before it.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rastro.session import checked_broadcast, pinned

HOT_ROWS = 5_000_000


def running_total(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    weight: Column | None = None,
    name: str = "total",
    hot_rows: int = HOT_ROWS,
    written: bool = False,
) -> DataFrame:
    """Add ``name``: the sum of ``weight`` up to each row, per key, in ``order``.

    ``order`` must be total within a key. With no keys the whole table is one
    group. Without ``weight`` the result is the row number, starting at 1. The table is read
    for its sizes and for its rows, so it is pinned, unless it is a ``written`` one.
    """
    df = df if written else pinned(df)
    weight = F.lit(1).cast("bigint") if weight is None else weight
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    hot = pinned(sizes.filter(F.col("_rows") > hot_rows))
    n_hot, rows_hot = hot.agg(F.count(F.lit(1)), F.coalesce(F.sum("_rows"), F.lit(0))).first()
    if n_hot == 0:
        return _within(df, keys, order, weight, name)

    slices = 4 * ceil(rows_hot / hot_rows)
    if not keys:
        return _sliced(df, keys, order, weight, name, slices)
    hot_keys = checked_broadcast(hot.select(*keys), n_hot)
    cold = _within(df.join(hot_keys, keys, "left_anti"), keys, order, weight, name)
    spread_out = _sliced(df.join(hot_keys, keys, "left_semi"), keys, order, weight, name, slices)
    return cold.unionByName(spread_out).select(*df.columns, name)


def _within(df, keys, order, weight, name):
    window = Window.partitionBy(*keys).orderBy(*order)
    running = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(name, F.sum(weight).over(running))


def _sliced(df, keys, order, weight, name, slices):
    ranged = df.repartitionByRange(slices, *[F.col(k) for k in keys], *order)
    # Pinned, so that a task that runs again finds the same slices.
    placed = pinned(ranged.withColumn("_slice", F.spark_partition_id()))
    slice_keys = [*keys, "_slice"]
    totals = placed.groupBy(*slice_keys).agg(F.sum(weight).alias("_in_slice"))
    earlier = (
        Window.partitionBy(*keys)
        .orderBy("_slice")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = totals.withColumn(
        "_before", F.coalesce(F.sum("_in_slice").over(earlier), F.lit(0))
    ).drop("_in_slice")
    inner = _within(placed.join(offsets, slice_keys), slice_keys, order, weight, "_inner")
    return inner.withColumn(name, F.col("_before") + F.col("_inner")).select(*df.columns, name)


def row_rank(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    name: str,
    hot_rows: int = HOT_ROWS,
    written: bool = False,
) -> DataFrame:
    """Ordinal rank 1..n of each row within its key."""
    return running_total(df, keys, order, None, name, hot_rows, written)


def first_rows(df: DataFrame, order: list[Column], n: int, heap_rows: int = 10_000) -> DataFrame:
    """The first n rows of a total order, as a table.

    A small n is a top-k sort, which brings n rows of every task together; a
    large one goes through the sliced rank, so that no task gathers the prefix.
    """
    if n <= heap_rows:
        return df.orderBy(*order).limit(n)
    ranked = row_rank(df, [], order, "_position")
    return ranked.filter(F.col("_position") <= n).drop("_position")


def exact_percentiles(
    df: DataFrame,
    keys: list[str],
    value: str,
    points: dict[str, float],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Percentiles with linear interpolation, one row per key.

    Equal values are merged before the sort, and no task holds a whole group:
    the two values around each position are picked out of the running counts.
    """
    present = df.filter(F.col(value).isNotNull())
    counts = pinned(present.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n")))
    sizes = counts.groupBy(*keys).agg(F.sum("_n").alias("_size"))
    upto = running_total(counts, keys, [F.col(value).asc()], F.col("_n"), "_upto", hot_rows, True)
    spread = upto.join(checked_broadcast(sizes), keys)
    picks = []
    for label, p in points.items():
        position = (F.col("_size") - 1) * F.lit(p)
        for end, wanted in (("lo", F.floor(position)), ("hi", F.ceil(position))):
            holds = (F.col("_upto") - F.col("_n") <= wanted) & (wanted < F.col("_upto"))
            picks.append(F.max(F.when(holds, F.col(value))).alias(f"_{label}_{end}"))
    ends = spread.groupBy(*keys, "_size").agg(*picks)
    results = []
    for label, p in points.items():
        position = (F.col("_size") - 1) * F.lit(p)
        low, high = F.col(f"_{label}_lo"), F.col(f"_{label}_hi")
        results.append((low + (high - low) * (position - F.floor(position))).alias(label))
    return ends.select(*keys, *results)
