import pytest

from check_oracle import differences, duck
from rastro.operators import perf
from rastro.plans import pipeline
from rastro.plans.adapters import events_log, orders_log
from rastro.plans.catalog import QUERIES
from rastro.plans.oracle import ORACLE
from rastro.session import pinned
from rastro.sources import sinks
from rastro.sources.tables import read_table


@pytest.fixture(scope="module")
def connection(sf_dir):
    return duck(sf_dir)


def test_every_sql_belongs_to_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf_dir, connection, name):
    result = QUERIES[name](spark, sf_dir).toPandas()
    assert differences(result, connection.execute(ORACLE[name]).df()) is None


@pytest.mark.parametrize("name", ["src_partition_count", "seg_dispersion", "rec_topn_user"])
def test_queries_without_sql_give_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_fitted_lists(spark, sf_dir):
    from rastro.plans.catalog import fitted

    fit = fitted(spark, sf_dir)
    lists = fit.lists
    assert lists.groupBy("visitorid").agg({"rank": "max", "itemid": "count"}).filter("`max(rank)` <> 10").count() == 0
    seen = fit.split[0].select("visitorid", "itemid").distinct()
    assert lists.join(seen, ["visitorid", "itemid"], "left_semi").count() == 0
    metrics = QUERIES["eval_full_als"](spark, sf_dir).first()
    assert metrics["hit_rate@10"] >= metrics["ndcg@10"] >= metrics["map@10"]


def test_whole_run(spark, sf_dir, tmp_path):
    raw = sinks.write_csv(orders_log(spark, sf_dir), str(tmp_path / "raw"))
    run = pipeline.run_pipeline(spark, [raw], str(tmp_path / "out"), n_clusters=3, factors=4, iterations=3, n_users=20)
    events = read_table(spark, run.paths["eventos"])
    assert run.counts["filas_antes"] == orders_log(spark, sf_dir).count()
    assert run.counts["filas_despues"] == events.count()
    segments = read_table(spark, run.paths["segmentos"])
    assert segments.count() == events.select("visitorid").distinct().count()
    lists = read_table(spark, run.paths["recomendaciones"])
    assert lists.select("visitorid").distinct().count() == 20 and lists.count() == 200
    shares = {r.etapa for r in perf.stage_shares(run.stage_times(spark)).collect()}
    assert shares == {"ingesta", "segmentos", "entrenamiento", "inferencia", "TOTAL"}


def test_a_run_with_metrics(spark, sf_dir, tmp_path):
    raw = sinks.write_csv(orders_log(spark, sf_dir), str(tmp_path / "raw"))
    run = pipeline.run_pipeline(
        spark, [raw], str(tmp_path / "out"), n_clusters=3, factors=4, iterations=3, n_users=5, evaluate=True
    )
    row = read_table(spark, run.paths["metricas"]).first()
    assert row.usuarios_evaluados > 0 and row["hit_rate@10"] >= row["ndcg@10"] >= row["map@10"]
    assert list(run.seconds)[-1] == "evaluacion"


def test_places_give_the_metrics_of_lists(spark, sf_dir):
    from rastro.operators import evaluate as ev
    from rastro.plans.catalog import fitted

    fit = fitted(spark, sf_dir)
    lists = pinned(fit.fixed_ranking.lists(fit.known, 10))
    by_lists = ev.full_metrics(fit.known, lists, 10).first()
    assert by_lists == ev.metrics_of_places(fit.fixed_ranking.places(fit.known), 10).first()


def test_ingest_counts_duplicates(spark, sf_dir, tmp_path):
    _, counts = pipeline.ingest(events_log(spark, sf_dir), str(tmp_path / "clean"))
    assert counts["filas_antes"] > counts["filas_despues"] > 0


def test_entry(spark):
    from __spark_entry__ import entry

    rates = entry(spark)
    assert rates.columns == ["cluster", "hit_rate@10", "n_usuarios_evaluados"]
    assert rates.count() > 0


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_density_copies_no_cells(spark, sf_dir):
    assert "Expand" not in plan_of(QUERIES["agg_matrix_density"](spark, sf_dir))


def test_candidates_broadcast_no_exploded_table(spark, sf_dir):
    """The bounded list of places comes as a scalar; beyond it nothing is broadcast."""
    from rastro.plans import fixed
    from rastro.plans.catalog import split_of

    train = split_of(spark, sf_dir)[0]
    scores = fixed.item_scores(train, fixed.by_weight())
    whole = fixed.candidates(train, scores, 10)
    few = fixed.candidates(train, scores, 10, held=3)

    columns = ["visitorid", "itemid", "score"]
    assert whole.select(columns).exceptAll(few.select(columns)).count() == 0
    assert few.count() == whole.count()


def test_indices_of_wide_ids(spark, as_rows):
    from rastro.operators.index import index_ids

    ids = [-(2**63), -(2**40), -1, 0, 1, 65_535, 65_536, 2**33, 2**33 + 5, 2**49, 2**63 - 1]
    df = spark.createDataFrame([(i,) for i in [*ids, *ids, None]], "visitorid long")
    assert as_rows(index_ids(df, "visitorid", "u_idx")) == [(i, k) for k, i in enumerate(ids)]


def test_popular_lists_for_new_visitors(spark, as_rows):
    from rastro.operators import recommend as rec

    cells = spark.createDataFrame([(1, 10, 3), (2, 10, 1), (1, 11, 4), (2, 12, 9)], "visitorid long, itemid long, peso long")
    popular = rec.popular_items(cells, 2)
    assert as_rows(popular) == [(1, 12, 9.0), (2, 10, 4.0)]
    visitors = spark.createDataFrame([(1,), (7,), (7,)], "visitorid long")
    got = rec.popular_for_new(visitors, cells.select("visitorid").distinct(), popular)
    assert as_rows(got) == [(7, 1, 12, 9.0), (7, 2, 10, 4.0)]


def test_a_cluster_without_a_shared_folder_is_refused():
    from types import SimpleNamespace

    from rastro.session import shared_folder

    for master in ("local-cluster[2,1,1024]", "yarn"):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
        spark = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda *_: None))
        with pytest.raises(RuntimeError):
            shared_folder(spark)
