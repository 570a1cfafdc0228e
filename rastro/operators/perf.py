"""Analysis of measurement tables: repetitions, scaling, stages, load, balance.

Inputs are long tables with one row per measurement. They are merged to one row
per configuration first, and only these small tables are joined or fitted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rastro.functions.columns import round_even
from rastro.functions.running import HOT_ROWS, exact_percentiles

# Steps of the grid on which the sequential fraction is searched.
AMDAHL_STEPS = 10_000


def summarize_runs(runs: DataFrame, keys: list[str], time: str = "t_s") -> DataFrame:
    """Mean, sample deviation (0 for one run), least, greatest and number of runs."""
    return runs.groupBy(*keys).agg(
        F.round(F.avg(time), 4).alias("media_s"),
        F.round(F.coalesce(F.stddev_samp(time), F.lit(0.0)), 4).alias("std_s"),
        F.round(F.min(time), 4).alias("min_s"),
        F.round(F.max(time), 4).alias("max_s"),
        F.count(F.lit(1)).alias("n_repeticiones"),
    )


def _with_base(table: DataFrame, keys: list[str], workers: str, time: str) -> DataFrame:
    """Add ``_base``: the time of the one-worker row of the same key."""
    base = table.groupBy(*keys).agg(F.max(F.when(F.col(workers) == 1, F.col(time))).alias("_base"))
    return table.join(base, keys) if keys else table.withColumn("_base", base.scalar())


def speedup(
    summary: DataFrame, keys: list[str], workers: str = "workers", time: str = "media_s"
) -> DataFrame:
    """Speedup over one worker and efficiency, both to three decimals.

    The efficiency divides the speedup that is shown, that is the rounded one.
    """
    gain = round_even(F.try_divide(F.col("_base"), F.col(time)), 3)
    return (
        _with_base(summary, keys, workers, time)
        .withColumn("speedup", gain)
        .withColumn("eficiencia", round_even(F.col("speedup") / F.col(workers), 3))
        .drop("_base")
    )


def weak_efficiency(
    summary: DataFrame, keys: list[str], workers: str = "workers", time: str = "media_s"
) -> DataFrame:
    """One-worker time over time, for input that grows with the workers."""
    ratio = round_even(F.try_divide(F.col("_base"), F.col(time)), 3)
    based = _with_base(summary, keys, workers, time)
    return based.withColumn("eficiencia_debil", ratio).drop("_base")


def amdahl_fit(
    points: DataFrame, keys: list[str], workers: str = "workers", speedup: str = "speedup"
) -> DataFrame:
    """Least-squares sequential fraction S of speedup = 1 / (S + (1−S)/N).

    Points with the same N are merged to their mean and number, which leaves the
    minimum where it is. S is searched on a grid over 0…1 inside each row.
    """
    merged = points.groupBy(*keys, workers).agg(
        F.avg(speedup).alias("s"), F.count(F.lit(1)).cast("double").alias("w")
    )
    lists = merged.groupBy(*keys).agg(
        # One entry per distinct N: as long as the list of configurations.
        F.sort_array(
            F.collect_list(F.struct(F.col(workers).cast("double").alias("n"), "s", "w"))
        ).alias("_p")
    )

    def error(fraction: Column) -> Column:
        def add(total: Column, point: Column) -> Column:
            model = 1.0 / (fraction + (1.0 - fraction) / point["n"])
            gap = point["s"] - model
            return total + point["w"] * gap * gap

        return F.aggregate("_p", F.lit(0.0), add)

    def candidate(step: Column) -> Column:
        fraction = step / F.lit(float(AMDAHL_STEPS))
        return F.struct(error(fraction).alias("e"), fraction.alias("f"))

    grid = F.transform(F.sequence(F.lit(0), F.lit(AMDAHL_STEPS)), candidate)
    best = lists.withColumn("fraccion_secuencial", F.array_min(grid)["f"])
    ceiling = F.try_divide(F.lit(1.0), F.col("fraccion_secuencial"))
    return best.select(*keys, "fraccion_secuencial", F.round(ceiling, 4).alias("speedup_maximo"))


def amdahl_points(
    points: DataFrame, workers: str = "workers", speedup: str = "speedup"
) -> DataFrame:
    """The sequential fraction that each single point implies, and its ceiling."""
    inverse = F.try_divide(F.lit(1.0), F.col(workers).cast("double"))
    fraction = F.try_divide(F.try_divide(F.lit(1.0), F.col(speedup)) - inverse, 1.0 - inverse)
    return points.filter(F.col(workers) > 1).select(
        "*",
        F.round(fraction, 4).alias("fraccion_secuencial"),
        F.round(F.try_divide(F.lit(1.0), fraction), 4).alias("speedup_limite"),
    )


def weak_linear_fit(
    runs: DataFrame, keys: list[str], workers: str = "workers", time: str = "t_s"
) -> DataFrame:
    """Line T(N) = a + b·N through the weak-scaling times."""
    return runs.groupBy(*keys).agg(
        F.round(F.regr_intercept(time, workers), 3).alias("a"),
        F.round(F.regr_slope(time, workers), 3).alias("b"),
    )


def best_configurations(
    summary: DataFrame, stage: str, workers: str = "workers", time: str = "media_s"
) -> DataFrame:
    """Per stage: one-worker time, best time, its number of workers, best speedup."""
    base = F.max(F.when(F.col(workers) == 1, F.col(time)))
    best = F.min(time)
    return summary.groupBy(stage).agg(
        base.alias("tiempo_secuencial_s"),
        best.alias("mejor_tiempo_s"),
        F.min(F.struct(F.col(time), F.col(workers)))[workers].alias("mejor_configuracion"),
        round_even(F.try_divide(base, best), 3).alias("speedup_maximo"),
    )


def stage_shares(times: DataFrame, stage: str = "etapa", time: str = "t_s") -> DataFrame:
    """Seconds per stage and their share of the whole, with a TOTAL row."""
    per_stage = times.groupBy(stage).agg(F.sum(time).alias("_t"))
    summed = per_stage.rollup(stage).agg(
        F.sum("_t").alias("_t"), F.grouping(stage).alias("_all")
    )
    whole = per_stage.agg(F.sum("_t")).scalar()
    return summed.withColumn("_whole", whole).select(
        F.when(F.col("_all") == 1, F.lit("TOTAL")).otherwise(F.col(stage)).alias(stage),
        F.round("_t", 4).alias("tiempo_s"),
        round_even(100.0 * F.try_divide(F.col("_t"), F.col("_whole")), 1).alias(
            "porcentaje_del_total"
        ),
    )


def batch_latency(
    runs: DataFrame, size: str = "tamano_lote", latency: str = "latencia_s"
) -> DataFrame:
    """Mean latency per batch size, per user, and users per second."""
    means = runs.groupBy(size).agg(F.avg(latency).alias("_s"))
    seconds, users = F.col("_s"), F.col(size)
    return means.select(
        size,
        F.round(seconds, 6).alias("latencia_media_s"),
        F.round(seconds * 1000, 4).alias("latencia_media_ms"),
        F.round(seconds / users * 1000, 4).alias("latencia_por_usuario_ms"),
        F.round(F.try_divide(users.cast("double"), seconds), 4).alias("throughput_usuarios_por_s"),
    )


def load_statistics(
    requests: DataFrame,
    level: str = "n_concurrentes",
    latency: str = "latencia_s",
    total: Column | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Per concurrency level: latencies in ms, throughput and error rate.

    ``total`` aggregates the wall time of a level; by default from the start of
    the first request to the end of the last, out of ``inicio_s``.
    """
    if total is None:
        total = F.max(F.col("inicio_s") + F.col(latency)) - F.min("inicio_s")
    means = requests.groupBy(level).agg(
        F.count(F.lit(1)).alias("n_solicitudes"),
        total.alias("_total"),
        F.avg(latency).alias("_mean"),
        F.max(latency).alias("_max"),
        F.count_if("error").alias("n_errores"),
    )
    points = {"_p50": 0.50, "_p95": 0.95, "_p99": 0.99}
    tails = exact_percentiles(requests.select(level, latency), [level], latency, points, hot_rows)

    def ms(column: str, name: str) -> Column:
        return F.round(F.col(column) * 1000, 3).alias(name)

    return means.join(tails, level).select(
        level,
        "n_solicitudes",
        F.round("_total", 3).alias("tiempo_total_s"),
        F.round(F.try_divide(F.col("n_solicitudes").cast("double"), F.col("_total")), 6).alias(
            "throughput_req_por_s"
        ),
        ms("_mean", "latencia_media_ms"),
        ms("_p50", "latencia_p50_ms"),
        ms("_p95", "latencia_p95_ms"),
        ms("_p99", "latencia_p99_ms"),
        ms("_max", "latencia_max_ms"),
        "n_errores",
        F.round(F.col("n_errores") / F.col("n_solicitudes"), 6).alias("tasa_error"),
    )


def worker_balance(tasks: DataFrame, worker: str = "worker") -> DataFrame:
    """Spread of busy time over workers and the total time spent on transfers.

    ``tasks`` has (worker, action, start_s, stop_s); the deviation is that of
    the whole population of workers.
    """
    spent = F.col("stop_s") - F.col("start_s")
    per_worker = tasks.groupBy(worker).agg(
        F.sum(F.when(F.col("action") == "compute", spent)).alias("_busy"),
        F.sum(F.when(F.col("action") == "transfer", spent)).alias("_moved"),
    )
    totals = per_worker.agg(
        F.count(F.lit(1)).alias("n_workers"),
        F.count("_busy").alias("workers_con_trabajo_asignado"),
        F.coalesce(F.avg("_busy"), F.lit(0.0)).alias("_mean"),
        F.coalesce(F.stddev_pop("_busy"), F.lit(0.0)).alias("_std"),
        F.coalesce(F.sum("_moved"), F.lit(0.0)).alias("_moved"),
    )
    variation = F.when(F.col("_mean") > 0, F.col("_std") / F.col("_mean")).otherwise(0.0)
    return totals.select(
        "n_workers",
        "workers_con_trabajo_asignado",
        F.round("_mean", 4).alias("media_tiempo_ocupado_s"),
        F.round("_std", 4).alias("std_tiempo_ocupado_s"),
        F.round(variation, 6).alias("coef_variacion"),
        F.round("_moved", 4).alias("tiempo_transferencia_total_s"),
    )


def tool_stages(
    times: DataFrame,
    stages: list[str],
    base_tool: str,
    resources: dict[str, int],
    tool: str = "herramienta",
    stage: str = "etapa",
    time: str = "t_s",
) -> DataFrame:
    """Mean seconds per stage and tool, total, speedup over a tool, efficiency."""
    means = times.groupBy(tool).pivot(stage, stages).agg(F.avg(time))
    whole = sum((F.col(s) for s in stages[1:]), F.col(stages[0]))
    totals = means.withColumn("_total", whole)
    base = totals.filter(F.col(tool) == base_tool).agg(F.max("_total")).scalar()
    pairs = [F.lit(part) for item in resources.items() for part in item]
    gain = round_even(F.try_divide(F.col("_base"), F.col("_total")), 2)
    return (
        totals.withColumn("_base", base)
        .withColumn("speedup", gain)
        .withColumn("recursos_usados", F.try_element_at(F.create_map(*pairs), F.col(tool)))
        .select(
            tool,
            *[F.round(s, 4).alias(f"{s}_s") for s in stages],
            F.round("_total", 4).alias("total_s"),
            "speedup",
            "recursos_usados",
            round_even(F.col("speedup") / F.col("recursos_usados"), 3).alias("eficiencia"),
        )
    )


def hotspots(calls: DataFrame, n: int = 15, name: str = "funcion") -> DataFrame:
    """The n entries with the greatest cumulative time.

    ``calls`` has (funcion, tiempo_propio_s, tiempo_acumulado_s), for example one
    row per task of an event log.
    """
    merged = calls.groupBy(name).agg(
        F.count(F.lit(1)).alias("llamadas"),
        F.round(F.sum("tiempo_propio_s"), 4).alias("tiempo_propio_s"),
        F.round(F.sum("tiempo_acumulado_s"), 4).alias("tiempo_acumulado_s"),
    )
    return merged.orderBy(F.desc("tiempo_acumulado_s"), name).limit(n)


def breakeven(
    sizes: DataFrame, first: str = "tiempo_cpu_s", second: str = "tiempo_gpu_s"
) -> DataFrame:
    """Sizes at which the second variant is faster, with the ratio of times."""
    return sizes.filter(F.col(second) < F.col(first)).withColumn(
        "speedup", F.round(F.try_divide(F.col(first), F.col(second)), 2)
    )


def stage_times_from_event_log(spark, path: str) -> DataFrame:
    """One row per finished task of a Spark event log, as ``hotspots`` input."""
    schema = (
        "Event string, `Stage ID` bigint, "
        "`Task Info` struct<`Launch Time`: bigint, `Finish Time`: bigint, `Executor ID`: string>, "
        "`Task Metrics` struct<`Executor Run Time`: bigint>"
    )
    ended = spark.read.schema(schema).json(path).filter(F.col("Event") == "SparkListenerTaskEnd")
    return ended.select(
        F.concat(F.lit("stage "), F.col("Stage ID").cast("string")).alias("funcion"),
        F.col("Task Info.Executor ID").alias("worker"),
        F.lit("compute").alias("action"),
        (F.col("Task Info.Launch Time") / 1000.0).alias("start_s"),
        (F.col("Task Info.Finish Time") / 1000.0).alias("stop_s"),
        (F.col("Task Metrics.Executor Run Time") / 1000.0).alias("tiempo_propio_s"),
        ((F.col("Task Info.Finish Time") - F.col("Task Info.Launch Time")) / 1000.0).alias(
            "tiempo_acumulado_s"
        ),
    )
