"""Session settings and the shared folder that holds pinned tables."""

from __future__ import annotations

import tempfile
import uuid
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_KEY = "spark.checkpoint.dir"
CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BROADCAST_ROWS = 100_000


def build_session(app: str = "rastro", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings the operators expect.

    On a cluster, master, memory and ``spark.checkpoint.dir`` come from
    spark-submit; nothing here overrides them.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Hash joins where every part of the smaller side was measured to fit.
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64m")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor can read, as named by the cluster.

    Only a session within one process gets a temporary folder without the setting; a cluster,
    ``local-cluster`` too, is refused, because a machine-local folder dies with its machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_KEY, None) or context.getCheckpointDir()
    if not folder:
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="rastro-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def remove_pinned(spark: SparkSession) -> None:
    """Deletes the application's part of the shared folder, with all pinned tables.

    For the end of a run: tables that were not written elsewhere are gone then.
    """
    remove_folder(spark, f"{shared_folder(spark).rstrip('/')}/rastro-{spark.sparkContext.applicationId}")


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Deletes one written table, by its owner, once nothing reads it any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def exists(spark: SparkSession, folder: str) -> bool:
    """Whether something was written there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the application's own part of the shared folder."""
    application = spark.sparkContext.applicationId
    return f"{shared_folder(spark).rstrip('/')}/rastro-{application}/{label}-{uuid.uuid4().hex}"


def pinned(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table.

    Used where a table is read several times or where its placement must not
    change when an executor is lost and its tasks run again. Parquet rather than
    a checkpoint of rows: later reads take only the columns they need, and the
    planner knows the size of the table.
    """
    return written(df, new_folder(df.sparkSession, "pinned"))


def written(df: DataFrame, path: str, mode: str = "error", by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` and go on from the written table.

    Its shuffle files go when it is written. Nothing reads them again, and else they stay until
    the driver's JVM happens to collect its garbage.
    """
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP_KEY, "false")
    conf.set(CLEANUP_KEY, "true")
    try:
        df.write.mode(mode).parquet(path, partitionBy=list(by) or None)
    finally:
        conf.set(CLEANUP_KEY, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(table: DataFrame, rows_per_task: int) -> DataFrame:
    """Spread a pinned table for work whose cost follows its rows and not its bytes."""
    parallel = table.sparkSession.sparkContext.defaultParallelism
    return table.repartition(max(parallel, ceil(table.count() / rows_per_task)))


def checked_broadcast(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Broadcast ``df`` when it is counted to be small; otherwise leave it to a shuffle.

    For narrow tables of keys and totals. Pass ``rows`` when the count is known.
    """
    if rows is None:
        df = pinned(df)
        rows = df.count()
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df
