"""The given tables seen as click logs and measurement tables.

The rows are real table rows; only the names change. Each log has the raw
schema, so it goes through the same cleaning as a file would.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# How kinds of rows in the given tables map to log events.
EVENT_NAMES = {"click": "addtocart", "purchase": "transaction"}
FLAG_NAMES = {"R": "view", "A": "addtocart", "N": "transaction"}
TWICE_DELIVERED = ["purchase", "error"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def epoch_millis(column: Column | str) -> Column:
    """Zone-less datetime → epoch milliseconds, rounded down."""
    micros = F.timestamp_diff(
        "MICROSECOND", F.expr("timestamp_ntz'1970-01-01 00:00:00'"), F.col(column)
    )
    return F.floor(micros / 1000).cast("bigint")


def _renamed(column: str, names: dict[str, str]) -> Column:
    renamed = F.col(column)
    for old, new in names.items():
        renamed = F.when(F.col(column) == old, F.lit(new)).otherwise(renamed)
    return renamed


def events_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as a dirty log.

    Sign-ups have no user yet, item 0 stands for no item, sign-ups and errors
    are no valid events, and purchases and errors were delivered twice.
    """
    kind = F.col("event_type")
    item = F.get_json_object("props", "$.k").cast("bigint")
    deliveries = F.when(kind.isin(TWICE_DELIVERED), 2).otherwise(1)
    return (
        table(spark, sf_dir, "events")
        .select(
            epoch_millis("ts").alias("timestamp"),
            F.when(kind != "signup", F.col("user_id")).alias("visitorid"),
            _renamed("event_type", EVENT_NAMES).alias("event"),
            F.nullif(item, F.lit(0).cast("bigint")).cast("double").alias("itemid"),
            F.when(kind == "purchase", F.col("event_id")).cast("double").alias("transactionid"),
            F.explode(F.array_repeat(F.lit(1), deliveries)).alias("_delivery"),
        )
        .drop("_delivery")
    )


def orders_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` with ``orders`` as a log: customers act on parts."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_returnflag")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    sold = F.when(F.col("l_returnflag") == "N", F.col("l_orderkey"))
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        epoch_millis("o_orderdate").alias("timestamp"),
        F.col("o_custkey").alias("visitorid"),
        _renamed("l_returnflag", FLAG_NAMES).alias("event"),
        F.col("l_partkey").cast("double").alias("itemid"),
        sold.cast("double").alias("transactionid"),
    )


def category_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts below their suppliers: many parents per category, as in a dirty tree."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("categoryid"), F.col("l_suppkey").alias("parentid")
    )


def item_properties(spark: SparkSession, sf_dir: str, column: str) -> DataFrame:
    """One dated property of every part sold."""
    return table(spark, sf_dir, "lineitem").select(
        epoch_millis("l_shipdate").alias("timestamp"),
        F.col("l_partkey").alias("itemid"),
        F.lit(column).alias("property"),
        F.col(column).alias("value"),
    )


def spreadsheet_text(millis: Column, digits: int) -> Column:
    """Epoch milliseconds the way a spreadsheet writes them, to some digits."""
    text = millis.cast("string")
    return F.concat(
        F.substring(text, 1, 1), F.lit(","), F.substring(text, 2, digits), F.lit("E+12")
    )


def run_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated runs: label, workers and seconds."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("etiqueta"),
        F.col("l_linenumber").alias("workers"),
        F.col("l_extendedprice").alias("t_s"),
    )


def scaling_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seconds per label and workers: the discounted share runs on one worker."""
    price, discount = F.col("l_extendedprice"), F.col("l_discount")
    shared = F.sum(price * (1 - discount)) / F.col("workers")
    lines = table(spark, sf_dir, "lineitem").groupBy(
        F.col("l_returnflag").alias("etiqueta"), F.col("l_linenumber").alias("workers")
    )
    return lines.agg(F.round(F.sum(price * discount) + shared, 2).alias("media_s"))


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests: the hour of the day stands for the concurrency level."""
    millis = epoch_millis("ts")
    return table(spark, sf_dir, "events").select(
        F.floor(F.pmod(millis, F.lit(86_400_000)) / 3_600_000).cast("int").alias("n_concurrentes"),
        F.col("value").alias("latencia_s"),
        (millis / 1000.0).alias("inicio_s"),
        (F.col("event_type") == "error").alias("error"),
    )


def task_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tasks of workers: open lines compute, finished ones transfer."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("worker"),
        F.when(F.col("l_linestatus") == "O", "compute").otherwise("transfer").alias("action"),
        F.lit(0.0).alias("start_s"),
        F.col("l_quantity").alias("stop_s"),
    )


def stage_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seconds per tool and stage."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("herramienta"),
        F.col("o_orderstatus").alias("etapa"),
        F.col("o_totalprice").alias("t_s"),
    )


def batch_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_size").alias("tamano_lote"), F.col("p_retailprice").alias("latencia_s")
    )


def call_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls of functions with their own and cumulative seconds."""
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("f"), F.col("l_suppkey").cast("string")).alias("funcion"),
        F.col("l_quantity").alias("tiempo_propio_s"),
        F.col("l_extendedprice").alias("tiempo_acumulado_s"),
    )


def variant_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two variants per size: open lines against finished ones."""

    def mean_of(status: str) -> Column:
        return F.avg(F.when(F.col("l_linestatus") == status, F.col("l_extendedprice")))

    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("n_filas"))
    return lines.agg(
        F.round(mean_of("O"), 6).alias("tiempo_cpu_s"),
        F.round(mean_of("F"), 6).alias("tiempo_gpu_s"),
    )
