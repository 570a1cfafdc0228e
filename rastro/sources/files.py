"""Readers for the raw CSV log, the category tree and the item properties."""

from __future__ import annotations

from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rastro.functions.columns import separator_of, spreadsheet_millis
from rastro.schemas import CATEGORY_TREE, EVENTS, ITEM_PROPERTIES, with_text_timestamp


#: Files whose headers are read at a time.
OPEN_FILES = 16


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when a file, folder or glob matches on whatever file system it names."""
    try:
        spark.read.text(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def resolve_path(spark: SparkSession, *candidates: str) -> str:
    """The first candidate that exists."""
    for path in candidates:
        if path_exists(spark, path):
            return path
    raise FileNotFoundError(f"none of these paths exists: {', '.join(candidates)}")


def first_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """(archivo, linea): the first line of every file that is not empty.

    The driver, which lists the files of a source in any case, opens each and reads up to the
    end of its first line, some files side by side. So what is read of a file is a buffer,
    whatever its size, and no task passes over the rest of it.
    """
    files = spark.read.text(list(paths)).inputFiles()
    with ThreadPool(max(1, min(OPEN_FILES, len(files)))) as pool:
        lines = pool.map(lambda file: _first_line(spark, file), files)
    found = [line for line in lines if line[1] is not None]
    return spark.createDataFrame(found, "archivo string, linea string")


def _first_line(spark: SparkSession, file: str) -> tuple[str, str | None]:
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
    stream = path.getFileSystem(conf).open(path)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
        plain = stream if codec is None else codec.createInputStream(stream)
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, "UTF-8"))
        return path.toString(), reader.readLine()
    finally:
        stream.close()


def detect_separator(spark: SparkSession, path: str) -> str:
    """Separator of one CSV file, from its first line; files with several are refused."""
    found = first_lines(spark, path).select(separator_of(F.col("linea")).alias("s")).distinct().collect()
    if len(found) != 1:
        raise ValueError(f"{path} is empty" if not found else f"{path} holds files of both kinds")
    return found[0].s


def _layouts(spark: SparkSession, paths: tuple[str, ...]) -> list[tuple[str, list[str], list[str]]]:
    """(separator, columns, files) for each kind of file below the paths."""
    lines = first_lines(spark, *paths)
    kinds = (
        lines.withColumn("sep", separator_of(F.col("linea")))
        .groupBy("sep", "linea")
        .agg(F.sort_array(F.collect_set("archivo")).alias("archivos"))
        .orderBy("sep", "linea")
    )
    # As many rows as kinds; the driver lists the files of a source in any case.
    found = []
    for row in kinds.collect():
        header = row.linea.lstrip("\ufeff").rstrip("\r")
        names = [name.strip().strip('"').strip() for name in header.split(row.sep)]
        found.append((row.sep, names, row.archivos))
    if not found:
        raise ValueError(f"{', '.join(paths)}: no lines")
    return found


def _read_csv(
    spark: SparkSession, paths: tuple[str, ...], schema: T.StructType, malformed: str | None = None
) -> DataFrame:
    """CSV sources, typed up front: files with one separator and header are read together, and
    columns go by name. Columns that the schema does not know are left out.

    A semicolon file went through a spreadsheet, which writes the timestamp with a decimal comma
    and an exponent. ``malformed`` names a column for the text of rows that do not fit the
    schema; what cannot be read of them is null.
    """
    parts = []
    for separator, names, files in _layouts(spark, paths):
        missing = set(schema.fieldNames()) - set(names)
        if missing:
            raise ValueError(f"{files[0]}: no column {', '.join(sorted(missing))}")
        repaired = separator == ";" and "timestamp" in schema.fieldNames()
        typed = with_text_timestamp(schema) if repaired else schema
        own = T.StructType(
            [
                T.StructField(name, typed[name].dataType if name in typed.fieldNames() else T.StringType())
                for name in names
            ]
        )
        reader = spark.read.option("header", True).option("sep", separator)
        if malformed:
            own = own.add(malformed, T.StringType())
            reader = reader.option("columnNameOfCorruptRecord", malformed)
        table = reader.schema(own).csv(files)
        if repaired:
            table = table.withColumn("timestamp", spreadsheet_millis(F.col("timestamp")))
        parts.append(table.select(*schema.fieldNames(), *([malformed] if malformed else [])))
    return _union(parts)


def count_malformed(spark: SparkSession, *paths: str, schema: T.StructType = EVENTS) -> DataFrame:
    """(filas, mal_formadas): rows of the files, and those that do not fit the schema."""
    table = _read_csv(spark, paths, schema, "_mal")
    broken = F.col("_mal").isNotNull()
    if "timestamp" in schema.fieldNames():
        # A timestamp of a spreadsheet file is text at first.
        broken = broken | F.col("timestamp").isNull()
    # True for every row, but makes the reader parse all columns: a broken value in a column
    # that nobody asks for is not found.
    broken = broken & F.xxhash64(*schema.fieldNames()).between(-(2**63), 2**63 - 1)
    return table.agg(F.count(F.lit(1)).alias("filas"), F.count_if(broken).alias("mal_formadas"))


def read_events(spark: SparkSession, *paths: str) -> DataFrame:
    """The raw log; every file may have its own separator and order of columns."""
    return _read_csv(spark, paths, EVENTS)


def read_category_tree(spark: SparkSession, *paths: str) -> DataFrame:
    return _read_csv(spark, paths, CATEGORY_TREE)


def read_item_properties(spark: SparkSession, *paths: str) -> DataFrame:
    """All parts of the item properties, one below the other, duplicates kept."""
    return _read_csv(spark, paths, ITEM_PROPERTIES)


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
