"""Contiguous indices for sorted ids, without sorting them in one place.

An id's index is the number of smaller ids. Ids are cut by their bits into blocks of at most
2^16 distinct ids, blocks into zones of at most 2^16 blocks, and so on up to at most 2^16 parts
of all 64-bit ids, so every window below sorts a bounded group. Blocks depend on the id alone,
so a task that runs again gives the same indices.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BITS = 16
LEVELS = 64 // BITS


def index_ids(table: DataFrame, id_column: str, index_column: str) -> DataFrame:
    """(id, index): index 0 … n−1 of the distinct non-null ids in ascending order."""
    ids = (
        table.select(F.col(id_column).cast("bigint").alias(id_column))
        .distinct()
        .filter(F.col(id_column).isNotNull())
        .withColumn("_key", F.shiftright(id_column, BITS))
    )
    # (key, ids) by block, by zone and so on.
    sizes = [ids.groupBy("_key").agg(F.count(F.lit(1)).alias("_ids"))]
    for _ in range(LEVELS - 2):
        lower = sizes[-1].withColumn("_key", F.shiftright("_key", BITS))
        sizes.append(lower.groupBy("_key").agg(F.sum("_ids").alias("_ids")))
    starts = None
    for level in reversed(sizes):
        # Within the part above, which is one for all at the top: at most 2^16 rows.
        level = level.withColumn("_above", F.shiftright("_key", BITS))
        part = Window.partitionBy("_above") if starts is not None else Window.partitionBy(F.lit(0))
        earlier = part.orderBy("_key").rowsBetween(Window.unboundedPreceding, -1)
        before = F.coalesce(F.sum("_ids").over(earlier), F.lit(0))
        placed = level.select("_key", "_above", before.alias("_start"))
        if starts is not None:
            above = starts.select(F.col("_key").alias("_above"), F.col("_start").alias("_first"))
            placed = placed.join(above, "_above").withColumn("_start", F.col("_start") + F.col("_first"))
        starts = placed.select("_key", "_start")
    in_block = Window.partitionBy("_key").orderBy(id_column)
    numbered = ids.withColumn("_place", F.row_number().over(in_block))
    return numbered.join(starts, "_key").select(
        id_column, (F.col("_start") + F.col("_place") - 1).alias(index_column)
    )


def index_cells(
    cells: DataFrame, users: DataFrame | None = None, items: DataFrame | None = None
) -> DataFrame:
    """Interactions with ``u_idx`` and ``i_idx`` next to the ids."""
    users = index_ids(cells, "visitorid", "u_idx") if users is None else users
    items = index_ids(cells, "itemid", "i_idx") if items is None else items
    return cells.join(users, "visitorid").join(items, "itemid").select(
        *cells.columns, "u_idx", "i_idx"
    )
