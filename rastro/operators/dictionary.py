"""A kept dictionary of contiguous indices that new days extend; given indices never move.

Every load has a folder of its own with the ids that no earlier load had. Loads are named in
ascending order (``2015-05-03``, ``2015-05-04`` …). A load that was lost half-way, or is repeated,
is written anew from the loads before it, so the same data give the same indices.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rastro.operators.index import index_ids
from rastro.session import exists

LOAD = "carga"


def read_dictionary(
    spark: SparkSession, path: str, id_column: str = "id", index_column: str = "indice"
) -> DataFrame:
    """(id, index, carga) of all loads; empty if nothing was written yet."""
    schema = f"`{id_column}` bigint, `{index_column}` bigint, {LOAD} string"
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(path)


def extend_dictionary(
    table: DataFrame, path: str, load: str, id_column: str = "id", index_column: str = "indice"
) -> DataFrame:
    """Adds the ids of ``table`` that are not in the dictionary; returns the whole of it.

    New ids follow the known ones in ascending order, without gaps. Null ids have no index,
    repeated ones a single one. What earlier loads hold is joined and counted, not ranked again:
    the work of ranking grows with the new ids. Only the newest load can be written again.
    """
    spark = table.sparkSession
    whole = read_dictionary(spark, path, id_column, index_column)
    later = whole.filter(F.col(LOAD) > load).select(LOAD).first()
    if later:
        raise ValueError(f"load {load!r} is older than {later[0]!r}, whose indices follow it")
    known = whole.filter(F.col(LOAD) < load)
    size = known.count()
    ids = table.select(F.col(id_column).cast("bigint").alias(id_column)).distinct()
    fresh = index_ids(ids.join(known.select(id_column), id_column, "left_anti"), id_column, index_column)
    fresh = fresh.withColumn(index_column, (F.col(index_column) + size).cast("bigint"))
    fresh.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{LOAD}={load}")
    return read_dictionary(spark, path, id_column, index_column)
