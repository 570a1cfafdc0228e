"""The whole run: raw log → clean Parquet → segments → model → lists → metrics.

Every stage writes its table and the next one reads it, so a lost executor
repeats one stage at most and no stage recomputes an earlier one.
"""

from __future__ import annotations

import time
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, SparkSession

from rastro.operators.aggregate import hit_rate_by_cluster, interactions, user_features
from rastro.operators.clean import clean_events
from rastro.operators.evaluate import metrics_of_places, user_hits
from rastro.operators.index import index_cells, index_ids
from rastro.operators.recommend import (
    fit_als,
    popular_for_new,
    popular_items,
    rank_index,
)
from rastro.operators.segments import segment_users
from rastro.operators.split import known_in_train, limit_test_users, split_events
from rastro.operators.topn import RankIndex
from rastro.operators.transform import transform_events
from rastro.session import new_folder, pinned, remove_folder, written
from rastro.sources.files import read_events
from rastro.sources.sinks import write_events, write_table
from rastro.sources.tables import read_table


@dataclass
class IndexedTrain:
    """Train interactions with their indices, and both index tables."""

    cells: DataFrame
    users: DataFrame
    items: DataFrame

    @property
    def seen(self) -> DataFrame:
        return self.cells.select("u_idx", "i_idx")


def index_train(train: DataFrame) -> IndexedTrain:
    path = new_folder(train.sparkSession, "cells")
    cells = written(interactions(train), path)
    users = pinned(index_ids(cells, "visitorid", "u_idx"))
    items = pinned(index_ids(cells, "itemid", "i_idx"))
    indexed = IndexedTrain(pinned(index_cells(cells, users, items)), users, items)
    remove_folder(train.sparkSession, path)
    return indexed


def ranking_of(model: ALSModel, train: IndexedTrain) -> RankIndex:
    """The model's factors laid out for lists and places; worth keeping for more than one
    question."""
    return rank_index(model, train.users, train.items, train.seen)


def recommend_all(
    model: ALSModel | RankIndex, train: IndexedTrain, visitors: DataFrame, n: int = 10, popular: bool = False
):
    """(visitorid, rank, itemid, score) for the visitors that occur in train.

    With ``popular`` all others get the list of the most popular items.
    """
    index = model if isinstance(model, RankIndex) else ranking_of(model, train)
    lists = index.lists(visitors, n)
    if not popular:
        return lists
    return lists.unionByName(popular_for_new(visitors, train.users, popular_items(train.cells, n)))


def ingest(raw: DataFrame, path: str) -> tuple[str, dict]:
    """Clean, transform and write a raw log; (path, rows before and after).

    The rows that are left are counted from the written files, and the raw rows
    by a scan without columns. Counters inside the writing job would be cheaper,
    but count the rows of tasks that run again twice.
    """
    write_events(transform_events(clean_events(raw)), path)
    before, after = raw.count(), read_table(raw.sparkSession, path).count()
    return path, {
        "filas_antes": before,
        "filas_despues": after,
        "eliminadas": before - after,
    }


@dataclass
class Run:
    """Paths of the written tables and seconds per stage."""

    paths: dict[str, str] = field(default_factory=dict)
    counts: dict = field(default_factory=dict)
    seconds: dict[str, float] = field(default_factory=dict)

    @contextmanager
    def stage(self, name: str):
        start = time.perf_counter()
        yield
        self.seconds[name] = time.perf_counter() - start

    def stage_times(self, spark: SparkSession) -> DataFrame:
        """(etapa, t_s), the input of ``stage_shares``."""
        return spark.createDataFrame(list(self.seconds.items()), "etapa string, t_s double")


def run_pipeline(
    spark: SparkSession,
    event_paths: list[str],
    out: str,
    n_clusters: int = 6,
    factors: int = 64,
    iterations: int = 15,
    n_users: int = 1000,
    n: int = 10,
    evaluate: bool = False,
) -> Run:
    """From raw files to lists for the first ``n_users`` users, written below ``out``; with
    ``evaluate`` to the ranking metrics over all test users, too."""
    run = Run()
    with run.stage("ingesta"):
        raw = read_events(spark, *event_paths)
        run.paths["eventos"], run.counts = ingest(raw, f"{out}/eventos")
    with run.stage("segmentos"):
        events = read_table(spark, run.paths["eventos"])
        features = read_table(spark, write_table(user_features(events), f"{out}/features"))
        run.paths["segmentos"] = write_table(
            segment_users(features, n_clusters), f"{out}/segmentos"
        )
    with run.stage("entrenamiento"):
        train, test = split_events(events)
        indexed = index_train(train)
        model = fit_als(indexed.cells, factors=factors, iterations=iterations)
        model.write().save(f"{out}/modelo")
        run.paths["modelo"] = f"{out}/modelo"
    with run.stage("inferencia"):
        first = limit_test_users(indexed.users.select("visitorid"), n_users)
        index = ranking_of(model, indexed)
        lists = recommend_all(index, indexed, first, n)
        run.paths["recomendaciones"] = write_table(lists, f"{out}/recomendaciones")
    if evaluate:
        with run.stage("evaluacion"):
            places = index.places(known_in_train(test, indexed.cells))
            run.paths["metricas"] = write_table(metrics_of_places(places, n), f"{out}/metricas")
    index.close()
    return run


def evaluate_by_cluster(
    events: DataFrame,
    segments: DataFrame,
    factors: int = 64,
    iterations: int = 15,
    k: int = 10,
) -> tuple[DataFrame, DataFrame]:
    """(metrics over all users, hit rate per segment) of a model fitted on train."""
    events = pinned(events)
    train, test = split_events(events)
    indexed = index_train(train)
    known = pinned(known_in_train(test, indexed.cells))
    model = fit_als(indexed.cells, factors=factors, iterations=iterations)
    places = pinned(ranking_of(model, indexed).places(known))
    hits = user_hits(known, places, k)
    return metrics_of_places(places, k), hit_rate_by_cluster(hits, segments, k)
