"""The click log as a stream: cleaning and hourly counts over files that keep arriving.

Both work in event time. A watermark trails the newest timestamp by ``delay``; until it has
passed a row's time, copies of the row are recognised and its window is open. Rows that arrive
behind it are late: they are dropped before any state is touched, and counted in the progress of
the query (``late_rows``). State is spread by hash of the row, or of window and event, so its
size follows the delay and not the age of the stream.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from rastro.functions.columns import utc_datetime
from rastro.operators.clean import drop_incomplete, item_as_integer, keep_valid_events
from rastro.schemas import EVENTS

#: State on the executors' disks, its changes in the checkpoint folder; it may outgrow memory.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
COUNTS = "inicio timestamp_ntz, fin timestamp_ntz, event string, cantidad long"


def stream_events(
    spark: SparkSession, path: str, files_per_batch: int | None = None, schema: StructType = EVENTS
) -> DataFrame:
    """Raw events from Parquet files that arrive in a folder, oldest file first."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def clean_stream(events: DataFrame, delay: str) -> DataFrame:
    """``clean_events`` of a stream, with the event time ``fecha``.

    Copies are dropped if they arrive while the watermark is behind them; a copy that arrives
    later is late like any other row, and so is no second row either. Rows without a timestamp
    have no place in event time and are dropped, other than in a table. The rest of the rules is
    that of the table: with a delay as long as the disorder of the files, both give the same rows.
    """
    dated = events.filter(F.col("timestamp").isNotNull()).withColumn("fecha", F.timestamp_millis("timestamp"))
    valid = keep_valid_events(drop_incomplete(dated)).withWatermark("fecha", delay)
    return item_as_integer(valid.dropDuplicatesWithinWatermark(events.columns))


def hourly_counts(cleaned: DataFrame, length: str = "1 hour") -> DataFrame:
    """(inicio, fin, event, cantidad) of each window and type of event, once it is closed."""
    counted = cleaned.groupBy(F.window("fecha", length).alias("_w"), "event").agg(F.count(F.lit(1)).alias("cantidad"))
    return _ends(counted, "_w").select("inicio", "fin", "event", "cantidad")


def _ends(counted: DataFrame, window: str) -> DataFrame:
    """Begin and end of each window in UTC, whatever the session's zone."""
    ends = {name: utc_datetime(F.unix_millis(f"{window}.{at}")) for name, at in (("inicio", "start"), ("fin", "end"))}
    return counted.withColumns(ends)


@dataclass
class Written:
    """What one run over the files that had arrived has done."""

    path: str
    checkpoint: str
    rows_in: int
    late: int


def write_available(stream: DataFrame, path: str, checkpoint: str) -> Written:
    """Takes all files that have arrived, in append mode, and stops.

    A further call with the same ``checkpoint`` goes on where the last one stopped, or was
    stopped: files that were committed are not read again, those of a batch that was not are.
    """
    spark = stream.sparkSession
    before = {key: spark.conf.get(key, None) for key in STATE_STORE}
    try:
        for key, value in STATE_STORE.items():
            spark.conf.set(key, value)
        query = (
            stream.writeStream.format("parquet")
            .outputMode("append")
            .option("path", path)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    query.awaitTermination()
    progress = query.recentProgress
    return Written(path, checkpoint, sum(p["numInputRows"] for p in progress), late_rows(query))


def late_rows(query: StreamingQuery) -> int:
    """Rows that the query dropped because they came behind the watermark."""
    operators: Iterable[dict] = (o for p in query.recentProgress for o in p["stateOperators"])
    return sum(o["numRowsDroppedByWatermark"] for o in operators)


def open_counts(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The counts of windows that are still open, from the state of the last batch.

    They are what has arrived so far; the stream emits a window once, when it is closed.
    """
    operators = spark.read.format("state-metadata").load(checkpoint)
    found = operators.filter(F.col("operatorName") == "stateStoreSave").select("operatorId").first()
    if found is None:
        return spark.createDataFrame([], COUNTS)
    state = spark.read.format("statestore").option("operatorId", found["operatorId"]).load(checkpoint)
    window, event = state.schema["key"].dataType.fieldNames()
    count = state.schema["value"].dataType.fieldNames()[-1]
    counted = state.select(
        F.col(f"key.`{window}`").alias("_w"),
        F.col(f"key.`{event}`").alias("event"),
        F.col(f"value.`{count}`").alias("cantidad"),
    )
    return _ends(counted, "_w").select("inicio", "fin", "event", "cantidad")


def all_counts(spark: SparkSession, written: Written) -> DataFrame:
    """Closed windows, as written, and the open ones."""
    return spark.read.schema(COUNTS).parquet(written.path).unionByName(open_counts(spark, written.checkpoint))
