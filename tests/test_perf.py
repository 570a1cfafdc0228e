import json

import pytest

from rastro.operators import perf

# Published measurements (workers, mean seconds, speedup).
ETL = [(1, 5.3655, 1.0), (2, 4.7104, 1.139), (4, 4.1887, 1.281), (8, 2.829, 1.897)]
KMEANS = [(1, 11.0665, 1.0), (2, 8.3738, 1.322), (4, 7.8759, 1.405), (8, 7.3131, 1.513)]
ALS = [(1, 106.9117, 1.0), (2, 99.1299, 1.079), (4, 98.2359, 1.088), (8, 97.9338, 1.092)]
STRONG = [(1, 7.0244, 1.0), (2, 4.9228, 1.427), (4, 4.2942, 1.636), (8, 2.9291, 2.398)]
WEAK = [(1, 0.7175), (2, 1.5691), (4, 2.1144), (8, 2.9842)]
STAGES = [
    ("ingesta", 3.45154509996064),
    ("clustering", 12.049232100020163),
    ("entrenamiento", 120.42525840003509),
    ("inferencia", 1.0319735000375658),
]


def sweep(spark):
    named = {"ETL": ETL, "K-Means": KMEANS, "ALS": ALS, "strong": STRONG}
    rows = [(name, w, t, s) for name, points in named.items() for w, t, s in points]
    return spark.createDataFrame(rows, "etiqueta string, workers int, media_s double, publicado double")


def test_published_speedups_and_efficiencies(spark):
    got = perf.speedup(sweep(spark), ["etiqueta"]).collect()
    assert all(r.speedup == r.publicado for r in got)
    etl = {r.workers: r.eficiencia for r in got if r.etiqueta == "ETL"}
    assert etl == {1: 1.0, 2: 0.57, 4: 0.32, 8: 0.237}
    strong = {r.workers: r.eficiencia for r in got if r.etiqueta == "strong"}
    assert strong == {1: 1.0, 2: 0.714, 4: 0.409, 8: 0.3}


def test_published_weak_scaling(spark):
    df = spark.createDataFrame([("x", w, t) for w, t in WEAK], "etiqueta string, workers int, media_s double")
    got = {r.workers: r.eficiencia_debil for r in perf.weak_efficiency(df, ["etiqueta"]).collect()}
    assert got == {1: 1.0, 2: 0.457, 4: 0.339, 8: 0.24}
    line = perf.weak_linear_fit(df, ["etiqueta"], time="media_s").first()
    assert (line.a, line.b) == (0.739, 0.295)
    whole = perf.weak_efficiency(df.drop("etiqueta"), [])
    assert {r.workers: r.eficiencia_debil for r in whole.collect()} == got


def test_published_sequential_fractions(spark):
    got = {
        r.etiqueta: r.fraccion_secuencial * 100
        for r in perf.amdahl_fit(perf.speedup(sweep(spark), ["etiqueta"]), ["etiqueta"]).collect()
    }
    assert got["ETL"] == pytest.approx(54.2, abs=0.1)
    assert got["K-Means"] == pytest.approx(60.4, abs=0.1)
    assert got["ALS"] == pytest.approx(89.2, abs=0.1)
    assert got["strong"] == pytest.approx(37.0, abs=0.1)


def test_single_point_fraction(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 1.6), (4, 4.0)], "workers int, speedup double")
    got = {r.workers: (r.fraccion_secuencial, r.speedup_limite) for r in perf.amdahl_points(df).collect()}
    assert got == {2: (0.25, 4.0), 4: (0.0, None)}


def test_published_stage_shares(spark):
    df = spark.createDataFrame(STAGES, "etapa string, t_s double")
    got = {r.etapa: r.porcentaje_del_total for r in perf.stage_shares(df).collect()}
    assert got == {"ingesta": 2.5, "clustering": 8.8, "entrenamiento": 87.9, "inferencia": 0.8, "TOTAL": 100.0}


def test_published_best_configurations(spark):
    got = {r.etiqueta: tuple(r)[1:] for r in perf.best_configurations(sweep(spark), "etiqueta").collect()}
    assert got["ETL"] == (5.3655, 2.829, 8, 1.897)
    assert got["K-Means"] == (11.0665, 7.3131, 8, 1.513)
    assert got["ALS"] == (106.9117, 97.9338, 8, 1.092)


def test_summary_of_runs(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 2.0)], "etiqueta string, t_s double")
    got = {r.etiqueta: tuple(r)[1:] for r in perf.summarize_runs(df, ["etiqueta"]).collect()}
    assert got == {"a": (2.0, 1.4142, 1.0, 3.0, 2), "b": (2.0, 0.0, 2.0, 2.0, 1)}


def test_published_latency(spark):
    df = spark.createDataFrame([(10, 0.033415899984538554), (1000, 1.1127360599813982)], "tamano_lote int, latencia_s double")
    got = {r.tamano_lote: r for r in perf.batch_latency(df).collect()}
    assert got[10].latencia_por_usuario_ms == 3.3416
    assert got[10].throughput_usuarios_por_s == pytest.approx(299.2587, abs=1e-4)
    assert got[1000].throughput_usuarios_por_s == pytest.approx(898.6857, abs=1e-4)


def test_load_statistics(spark):
    rows = [(2, 0.0, 0.1, False), (2, 0.0, 0.3, True), (2, 1.0, 0.2, False), (7, 5.0, 2.0, True)]
    df = spark.createDataFrame(rows, "n_concurrentes int, inicio_s double, latencia_s double, error boolean")
    got = {r.n_concurrentes: r for r in perf.load_statistics(df).collect()}
    two = got[2]
    assert (two.n_solicitudes, two.n_errores, two.latencia_p50_ms, two.latencia_max_ms) == (3, 1, 200.0, 300.0)
    assert (two.tiempo_total_s, two.throughput_req_por_s, two.tasa_error) == (1.2, 2.5, 0.333333)
    assert two.latencia_p95_ms == 290.0
    assert (got[7].tasa_error, got[7].latencia_p99_ms) == (1.0, 2000.0)


def test_balance(spark):
    rows = [
        ("w1", "compute", 0.0, 2.0), ("w1", "compute", 3.0, 4.0),
        ("w2", "compute", 0.0, 1.0), ("w2", "transfer", 1.0, 1.5), ("w3", "transfer", 0.0, 0.25),
    ]
    df = spark.createDataFrame(rows, "worker string, action string, start_s double, stop_s double")
    assert tuple(perf.worker_balance(df).first()) == (3, 2, 2.0, 1.0, 0.5, 0.75)


def test_published_tool_comparison(spark):
    # Published seconds per stage.
    tools = {
        "Pandas": (1.7788356493333215, 1.5621362529999867, 0.46120197400000507),
        "Polars": (0.4410640923333631, 0.8131946703333218, 0.1691574673333207),
        "Dask": (1.5884170203333194, 2.5139707106667024, 0.6431653133333081),
        "cuDF (GPU)": (0.0746482093333422, 0.02774380366671873, 0.046447204666643906),
    }
    stages = ["carga", "limpieza", "transformacion"]
    rows = [(tool, stage, t) for tool, times in tools.items() for stage, t in zip(stages, times)]
    df = spark.createDataFrame(rows, "herramienta string, etapa string, t_s double")
    resources = {"Pandas": 1, "Polars": 2, "Dask": 4, "cuDF (GPU)": 1}
    got = {r.herramienta: (r.speedup, r.eficiencia) for r in perf.tool_stages(df, stages, "Pandas", resources).collect()}
    assert got == {"Pandas": (1.0, 1.0), "Polars": (2.67, 1.335), "Dask": (0.8, 0.2), "cuDF (GPU)": (25.55, 25.55)}


def test_breakeven_and_hotspots(spark):
    sizes = spark.createDataFrame(
        [(100000, 0.5172385576665874, 0.3175219396668278), (5, 0.1, 0.2)],
        "n_filas long, tiempo_cpu_s double, tiempo_gpu_s double",
    )
    assert [tuple(r)[::3] for r in perf.breakeven(sizes).collect()] == [(100000, 1.63)]
    calls = spark.createDataFrame(
        [("f", 1.0, 2.0), ("g", 1.0, 9.0), ("f", 0.5, 3.0), ("h", 0.0, 1.0)],
        "funcion string, tiempo_propio_s double, tiempo_acumulado_s double",
    )
    assert [tuple(r) for r in perf.hotspots(calls, 2).collect()] == [("g", 1, 1.0, 9.0), ("f", 2, 1.5, 5.0)]


def test_event_log_feeds_hotspots_and_balance(spark, tmp_path):
    def task(stage, executor, start, stop):
        return {
            "Event": "SparkListenerTaskEnd",
            "Stage ID": stage,
            "Task Info": {"Launch Time": start, "Finish Time": stop, "Executor ID": executor},
            "Task Metrics": {"Executor Run Time": stop - start - 1},
        }

    events = [{"Event": "SparkListenerJobStart"}, task(0, "1", 0, 1000), task(0, "2", 0, 3000), task(1, "2", 3000, 3500)]
    path = tmp_path / "log"
    path.write_text("\n".join(json.dumps(e) for e in events))
    tasks = perf.stage_times_from_event_log(spark, str(path))
    assert [r.funcion for r in perf.hotspots(tasks).collect()] == ["stage 0", "stage 1"]
    balance = perf.worker_balance(tasks).first()
    assert (balance.n_workers, balance.media_tiempo_ocupado_s) == (2, 2.25)
