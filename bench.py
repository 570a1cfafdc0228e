"""Headline timings: one JSON line with seconds per query.

Each query runs once to warm up and then BENCH_REPS times; the median counts.
Queries write their whole result to the no-op sink, so nothing is optimised away.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from rastro.operators import aggregate as ag
from rastro.operators import evaluate as ev
from rastro.operators import implicit as im
from rastro.operators import neural as nn
from rastro.operators import recommend as rec
from rastro.operators import segments as sg
from rastro.operators import split as sp
from rastro.plans import adapters as ad
from rastro.plans import catalog
from rastro.plans.pipeline import index_train, ingest, ranking_of, recommend_all, run_pipeline
from rastro.session import build_session, new_folder, pinned, remove_pinned
from rastro.sources import files, sinks
from rastro.sources.tables import read_table

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPS = int(os.environ.get("BENCH_REPS", "3"))


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    spread: dict[str, list[float]] = {}

    def measure(name, action, reps=REPS, warm=True):
        taken, result = [], None
        for run in range(reps + warm):
            start = time.perf_counter()
            result = action()
            if run >= warm:
                taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken), 3)
        spread[name] = [round(min(taken), 3), round(max(taken), 3)]
        print(f"{name}: {times[name]} s {spread[name]}", file=sys.stderr, flush=True)
        return result

    # Inputs of the stages, written once and not timed.
    raw_csv = sinks.write_csv(ad.orders_log(spark, SF_DIR), new_folder(spark, "bench-raw"))

    def etl():
        return ingest(files.read_events(spark, raw_csv), new_folder(spark, "bench-events"))[0]

    events = read_table(spark, measure("etl_csv_clean_transform_write", etl))
    measure("clean_report", lambda: drain(catalog.QUERIES["clean_report"](spark, SF_DIR)))
    measure("agg_user_features", lambda: drain(ag.user_features(events)))
    measure("agg_interactions", lambda: drain(ag.interactions(events)))
    measure("agg_top_products", lambda: drain(ag.top_products(events)))
    measure("win_recency_rank", lambda: drain(sp.recency_rank(events)))

    def split():
        train, test = sp.split_events(events)
        drain(test)
        drain(train)

    measure("split_loo", split)
    features = pinned(ag.user_features(events))
    segments = measure("seg_kmeans_10_starts", lambda: pinned(sg.segment_users(features)), 1, True)

    train, test = sp.split_events(events)
    train = pinned(train)
    indexed = measure("index_and_matrix", lambda: index_train(train))
    model = measure("als_fit_64_factors_15_iterations", lambda: rec.fit_als(indexed.cells), 1, True)
    n_users, n_items = indexed.users.count(), indexed.items.count()
    measure("als_plain_objective_15_iterations", lambda: im.fit_implicit(indexed.cells, n_users, n_items), 1, False)
    known = pinned(sp.known_in_train(test, indexed.cells))
    index = measure("ranking_layout", lambda: ranking_of(model, indexed), 1)
    for n_users in (1, 1000, 10_000):
        users = pinned(sp.limit_test_users(indexed.users.select("visitorid"), n_users))
        measure(f"top10_{n_users}_users", lambda: drain(recommend_all(index, indexed, users)))

    # With the scoring of the whole catalogue, as all test users need it.
    measure("eval_full_with_scoring", lambda: ev.metrics_of_places(index.places(known)).collect(), 1)
    lists = pinned(recommend_all(index, indexed, known))
    hits = ev.user_hits(known, lists)
    measure("agg_hit_by_cluster", lambda: ag.hit_rate_by_cluster(hits, segments).collect())

    fit = catalog.fitted(spark, SF_DIR)
    fit.positives, fit.test_pairs  # noqa: B018 - inputs, not timed
    measure("rec_neg_train", lambda: drain(fit.training_pairs()), 1)

    measure("ranker_fit_10_epochs", lambda: nn.fit_neural(fit.positives, n_users, n_items), 1, False)
    measure(
        "whole_run",
        lambda: run_pipeline(spark, [raw_csv], new_folder(spark, "bench-run")),
        1,
        False,
    )

    def sampled():
        fit.__dict__.pop("eval_negatives", None)
        return catalog.QUERIES["eval_sampled"](spark, SF_DIR).collect()

    measure("eval_sampled_99_negatives", sampled, 1)
    for name in ("perf_load_stats", "perf_speedup", "perf_amdahl_fit", "perf_balance"):
        measure(name, lambda: drain(catalog.QUERIES[name](spark, SF_DIR)))

    rows = events.count()
    remove_pinned(spark)
    print(
        json.dumps(
            {
                "metric": "total median seconds of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "min_max": spread,
                "repetitions": REPS,
                "cores": int(CPUS),
                "rows": rows,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
