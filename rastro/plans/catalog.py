"""The registered queries: every operator applied to the given tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rastro.functions import columns as fn
from rastro.operators import aggregate as ag
from rastro.operators import clean as cl
from rastro.operators import dictionary as dc
from rastro.operators import evaluate as ev
from rastro.operators import implicit as im
from rastro.operators import index as ix
from rastro.operators import negatives as ng
from rastro.operators import neighbours as nb
from rastro.operators import neural as nn
from rastro.operators import perf
from rastro.operators import recommend as rec
from rastro.operators import segments as sg
from rastro.operators import sketches as sk
from rastro.operators import split as sp
from rastro.operators import transform as tr
from rastro.operators.topn import RankIndex
from rastro.plans import adapters as ad
from rastro.plans import fixed
from rastro.plans.pipeline import index_train, ranking_of, recommend_all
from rastro.schemas import CLUSTER_NAMES, EVENTS, FEATURE_COLUMNS
from rastro.session import new_folder, pinned
from rastro.sources import files, sinks, tables
from rastro.sources import user_log as ul
from rastro.streaming import events as st

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Sizes that are part of an operator, not of a check.
TOP_PRODUCTS = 15
TOP_N = 10
SAMPLE_USERS = 100
TEST_USERS = 1000
TRAIN_NEGATIVES = 4
EVAL_NEGATIVES = 99
FACTORS = 64
EPOCHS = 10


def query(name: str):
    def register(function: Query) -> Query:
        QUERIES[name] = function
        return function

    return register


def raw_log(spark, sf):
    return ad.events_log(spark, sf)


def clean_log(spark, sf):
    return cl.clean_events(ad.events_log(spark, sf))


def events_of(spark, sf):
    """The smaller log, cleaned and transformed."""
    return tr.transform_events(clean_log(spark, sf))


def orders_of(spark, sf):
    """The larger log, cleaned and transformed."""
    return tr.transform_events(cl.clean_events(ad.orders_log(spark, sf)))


def features_of(spark, sf):
    return pinned(ag.user_features(orders_of(spark, sf)))


def segments_of(spark, sf):
    """User features of the larger log with the segment of the nearest fixed centre."""
    return fixed.fixed_segments(features_of(spark, sf))


def split_of(spark, sf):
    return sp.split_events(pinned(orders_of(spark, sf)))


# --- sources and sinks -------------------------------------------------------


@query("src_detect_sep")
def src_detect_sep(spark, sf):
    documents = ad.table(spark, sf, "documents")
    first_line = F.substring_index("text", "\n", 1)
    return documents.select("doc_id", fn.separator_of(first_line).alias("separador"))


def write_log_files(spark, sf):
    """One folder: views in comma files, the others, with columns in another order, in
    spreadsheet files."""
    log, path = raw_log(spark, sf), new_folder(spark, "log")
    sinks.write_csv(log.filter(F.col("event") == "view"), path)
    text = log.filter(F.col("event") != "view").withColumn(
        "timestamp", ad.spreadsheet_text(F.col("timestamp"), 12)
    )
    mixed = text.select(*reversed(EVENTS.fieldNames()))
    return sinks.write_csv(mixed, path, ";", "append")


@query("src_events_csv")
def src_events_csv(spark, sf):
    return files.read_events(spark, write_log_files(spark, sf))


@query("src_malformed")
def src_malformed(spark, sf):
    """Views in a file of their own, where every order below 50 is no number."""
    log = raw_log(spark, sf).filter(F.col("event") == "view")
    item = F.when(F.col("itemid") < 50, F.lit("n/a")).otherwise(F.col("itemid").cast("string"))
    path = sinks.write_csv(log.withColumn("itemid", item), new_folder(spark, "log"))
    return files.count_malformed(spark, path)


@query("src_excel_ts")
def src_excel_ts(spark, sf):
    log = raw_log(spark, sf)
    text = ad.spreadsheet_text(F.col("timestamp"), 5)
    return log.select(
        F.col("timestamp").alias("exacto"), fn.spreadsheet_millis(text).alias("timestamp")
    )


@query("src_category_tree")
def src_category_tree(spark, sf):
    path = sinks.write_csv(ad.category_tree(spark, sf), new_folder(spark, "tree"))
    return files.read_category_tree(spark, path)


@query("src_item_props")
def src_item_props(spark, sf):
    part = ad.item_properties(spark, sf, "l_returnflag")
    return files.read_item_properties(spark, sinks.write_csv(part, new_folder(spark, "props")))


@query("src_item_props_union")
def src_item_props_union(spark, sf):
    paths = [
        sinks.write_csv(ad.item_properties(spark, sf, column), new_folder(spark, "props"))
        for column in ("l_returnflag", "l_linestatus")
    ]
    return files.read_item_properties(spark, *paths)


@query("src_path_fallback")
def src_path_fallback(spark, sf):
    written = sinks.write_csv(raw_log(spark, sf), new_folder(spark, "log"))
    return files.read_events(spark, files.resolve_path(spark, f"{written}-missing", written))


@query("src_parquet")
def src_parquet(spark, sf):
    path = sinks.write_table(clean_log(spark, sf), new_folder(spark, "clean"))
    return tables.read_table(spark, path)


@query("sink_events_parquet")
def sink_events_parquet(spark, sf):
    path = sinks.write_events(events_of(spark, sf), new_folder(spark, "events"))
    return tables.read_table(spark, path)


@query("sink_parquet")
def sink_parquet(spark, sf):
    segments = fixed.fixed_segments(pinned(ag.user_features(events_of(spark, sf))))
    path = sinks.write_table(segments, new_folder(spark, "segments"))
    return tables.read_table(spark, path)


@query("sink_csv")
def sink_csv(spark, sf):
    summary = perf.summarize_runs(ad.run_times(spark, sf), ["etiqueta", "workers"])
    path = sinks.write_csv(summary, new_folder(spark, "summary"))
    return spark.read.schema(summary.schema).option("header", True).csv(path)


@query("sink_json")
def sink_json(spark, sf):
    comparison = eval_compare(spark, sf)
    path = sinks.write_json(comparison, new_folder(spark, "comparison"), "comparacion")
    return spark.read.schema(
        f"comparacion struct<{comparison.schema.simpleString()[7:-1]}>"
    ).json(path).select("comparacion.*")


@query("src_subset")
def src_subset(spark, sf):
    log = pinned(sp.seen_pairs(clean_log(spark, sf)))
    return tables.subset(log, log.count() // 2, ["visitorid", "itemid"])


@query("src_partition_count")
def src_partition_count(spark, sf):
    path = f"{sf}/lineitem.parquet"
    return tables.partition_count_for_block(spark, path, "parquet", 4 * 1024 * 1024)


@query("src_synth_features")
def src_synth_features(spark, sf):
    features = tables.synthetic_features(ad.table(spark, sf, "orders"), "o_orderkey")
    return features.select(
        "o_orderkey", *[F.round(f"f{j}", 6).alias(f"f{j}") for j in range(6)]
    )


# --- cleaning and transforms -------------------------------------------------


@query("clean_dedupe")
def clean_dedupe(spark, sf):
    return cl.drop_copies(raw_log(spark, sf))


@query("clean_not_null")
def clean_not_null(spark, sf):
    return cl.drop_incomplete(raw_log(spark, sf))


@query("clean_valid_event")
def clean_valid_event(spark, sf):
    return cl.keep_valid_events(raw_log(spark, sf))


@query("clean_cast_item")
def clean_cast_item(spark, sf):
    return cl.item_as_integer(raw_log(spark, sf))


@query("clean_events")
def clean_events(spark, sf):
    return clean_log(spark, sf)


@query("clean_report")
def clean_report(spark, sf):
    return cl.cleaning_report(raw_log(spark, sf))


@query("quality_ts_precision")
def quality_ts_precision(spark, sf):
    """A log with exact timestamps and one whose timestamps are whole days.

    Of the second log the alert has to fire.
    """
    exact = cl.quality_report(raw_log(spark, sf)).withColumn("registro", F.lit("exacto"))
    days = cl.quality_report(ad.orders_log(spark, sf)).withColumn("registro", F.lit("dias"))
    return exact.unionByName(days)


@query("clean_category_tree")
def clean_category_tree(spark, sf):
    return cl.clean_category_tree(ad.category_tree(spark, sf))


@query("tr_epoch_ms")
def tr_epoch_ms(spark, sf):
    return tr.add_datetime(clean_log(spark, sf))


@query("tr_weight")
def tr_weight(spark, sf):
    """On the raw log, so that the default weight is used as well."""
    return tr.add_weight(raw_log(spark, sf))


@query("tr_hour_weekday")
def tr_hour_weekday(spark, sf):
    return tr.add_hour_weekday(clean_log(spark, sf))


@query("tr_events")
def tr_events(spark, sf):
    return events_of(spark, sf)


@query("tr_cluster_name")
def tr_cluster_name(spark, sf):
    named = tr.name_clusters(segments_of(spark, sf), CLUSTER_NAMES)
    return named.select("visitorid", "cluster", "cluster_nombre")


@query("tr_log1p")
def tr_log1p(spark, sf):
    return _rounded(tr.log_features(ag.user_features(events_of(spark, sf))))


def _rounded(features, digits=6):
    return features.select(
        "visitorid", *[F.round(c, digits).alias(c) for c in FEATURE_COLUMNS]
    )


# --- aggregates --------------------------------------------------------------


@query("agg_user_features")
def agg_user_features(spark, sf):
    return ag.user_features(events_of(spark, sf))


@query("agg_interactions")
def agg_interactions(spark, sf):
    return ag.interactions(orders_of(spark, sf))


@query("agg_matrix_density")
def agg_matrix_density(spark, sf):
    return ag.matrix_density(ag.interactions(orders_of(spark, sf)))


@query("agg_event_counts")
def agg_event_counts(spark, sf):
    return ag.event_counts(events_of(spark, sf))


@query("agg_hourly")
def agg_hourly(spark, sf):
    return ag.hourly_activity(events_of(spark, sf))


@query("agg_top_products")
def agg_top_products(spark, sf):
    return ag.top_products(orders_of(spark, sf), TOP_PRODUCTS)


@query("agg_kpis")
def agg_kpis(spark, sf):
    events = pinned(orders_of(spark, sf))
    return ag.kpis(events, fixed.fixed_segments(pinned(ag.user_features(events))))


@query("agg_kpis_days")
def agg_kpis_days(spark, sf):
    """Each month's figures from the days' sketches, kept in two loads, against exact counts."""
    events = pinned(orders_of(spark, sf))
    kept, late = (sk.daily_sketches(events.filter(F.col("itemid") % 2 == i)) for i in (0, 1))
    days = sk.merge_days(pinned(kept), pinned(late))
    month = F.date_format("dia", "yyyy-MM")
    exact = events.groupBy(F.date_format("fecha", "yyyy-MM").alias("periodo")).agg(
        F.count_distinct("visitorid").alias("u"), F.count_distinct("itemid").alias("p")
    )

    def near(estimate, truth):
        return F.abs(F.col(estimate) - F.col(truth)) <= sk.ERROR_BOUND * F.col(truth)

    return sk.kpis_of_days(days, month).join(exact, "periodo").select(
        "periodo",
        "eventos_totales",
        near("usuarios_unicos", "u").alias("usuarios_dentro"),
        near("productos_distintos", "p").alias("productos_dentro"),
    )


@query("agg_cluster_size")
def agg_cluster_size(spark, sf):
    return ag.cluster_sizes(segments_of(spark, sf))


@query("agg_cluster_profile")
def agg_cluster_profile(spark, sf):
    profile = ag.cluster_profile(segments_of(spark, sf))
    return profile.select("cluster", *[F.round(c, 6).alias(c) for c in FEATURE_COLUMNS])


@query("agg_cluster_minmax")
def agg_cluster_minmax(spark, sf):
    profile = ag.cluster_profile(segments_of(spark, sf))
    scaled = ag.scaled_profile(profile)
    return scaled.select("cluster", *[F.round(c, 6).alias(c) for c in ag.PROFILE_COLUMNS])


# --- split, joins, ranks, indices --------------------------------------------


@query("win_recency_rank")
def win_recency_rank(spark, sf):
    ranked = sp.recency_rank(clean_log(spark, sf))
    return ranked.select("visitorid", "timestamp", "itemid", "event", "rank_reciente")


@query("semi_evaluable")
def semi_evaluable(spark, sf):
    return sp.events_of_active_users(clean_log(spark, sf))


@query("split_loo_test")
def split_loo_test(spark, sf):
    return split_of(spark, sf)[1]


@query("split_loo_train")
def split_loo_train(spark, sf):
    return split_of(spark, sf)[0]


@query("join_known_in_train")
def join_known_in_train(spark, sf):
    train, test = split_of(spark, sf)
    return sp.known_in_train(test, train)


@query("index_ids")
def index_ids(spark, sf):
    return ix.index_ids(clean_log(spark, sf), "visitorid", "u_idx")


@query("index_dictionary")
def index_dictionary(spark, sf):
    """Users of the first half of the log's time, then those of the second."""
    log = pinned(clean_log(spark, sf))
    middle = log.agg(F.floor((F.min("timestamp") + F.max("timestamp")) / 2)).scalar()
    path = new_folder(spark, "dictionary")
    dc.extend_dictionary(log.filter(F.col("timestamp") <= middle), path, "a", "visitorid", "u_idx")
    return dc.extend_dictionary(log.filter(F.col("timestamp") > middle), path, "b", "visitorid", "u_idx")


def user_log_of(spark, sf):
    buckets = max(8, spark.sparkContext.defaultParallelism)
    return ul.write_user_log(orders_of(spark, sf), new_folder(spark, "user-log"), buckets)


@query("user_log_features")
def user_log_features(spark, sf):
    return user_log_of(spark, sf).by_user(ag.user_features)


@query("user_log_evaluable")
def user_log_evaluable(spark, sf):
    return user_log_of(spark, sf).by_user(sp.events_of_active_users)


@query("user_log_split_test")
def user_log_split_test(spark, sf):
    return user_log_of(spark, sf).split()[1]


@query("user_log_split_train")
def user_log_split_train(spark, sf):
    return user_log_of(spark, sf).split()[0]


@query("join_id_index")
def join_id_index(spark, sf):
    return ix.index_cells(pinned(ag.interactions(orders_of(spark, sf))))


@query("anti_seen")
def anti_seen(spark, sf):
    train = pinned(split_of(spark, sf)[0])
    pool = fixed.candidates(train, fixed.item_scores(train, fixed.by_weight()), TOP_N)
    return sp.unseen_only(pool, sp.seen_pairs(train))


@query("set_user_items")
def set_user_items(spark, sf):
    return sp.seen_pairs(orders_of(spark, sf))


@query("set_union_all")
def set_union_all(spark, sf):
    """Both logs, one below the other."""
    return raw_log(spark, sf).unionByName(ad.orders_log(spark, sf)).select(*EVENTS.fieldNames())


@query("limit_test_users")
def limit_test_users(spark, sf):
    return sp.limit_test_users(split_of(spark, sf)[1], TEST_USERS)


@query("sample_users")
def sample_users(spark, sf):
    return sp.sample_users(orders_of(spark, sf), SAMPLE_USERS)


# --- streams -----------------------------------------------------------------

#: The log arrives in so many deliveries, each of about so many files.
DELIVERIES, FILES_PER_DELIVERY = 4, 4


def write_landing(spark, sf):
    """(folder, delay): the raw log as files that arrive one delivery after the other.

    A delivery has a quarter of the log's time; what is delivered twice comes again one delivery
    later. The delay is two deliveries long.
    """
    log, path = pinned(raw_log(spark, sf)), new_folder(spark, "landing")
    first, last = log.agg(F.min("timestamp"), F.max("timestamp")).first()
    span = (last - first) // DELIVERIES + 1
    once = pinned(log.dropDuplicates().withColumn("_k", F.floor((F.col("timestamp") - first) / span)))
    again = F.col("event").isin("transaction", "error")
    for k in range(DELIVERIES + 1):
        arriving = once.filter((F.col("_k") == k) | ((F.col("_k") == k - 1) & again)).drop("_k")
        arriving.repartition(FILES_PER_DELIVERY).write.mode("append").parquet(path)
    return path, f"{2 * span} milliseconds"


@query("ext_stream_clean")
def ext_stream_clean(spark, sf):
    """The log cleaned as it arrives, file by file, into a table."""
    path, delay = write_landing(spark, sf)
    cleaned = st.clean_stream(st.stream_events(spark, path, FILES_PER_DELIVERY), delay)
    out = st.write_available(cleaned, new_folder(spark, "cleaned"), new_folder(spark, "cleaning"))
    return spark.read.parquet(out.path).select(*EVENTS.fieldNames())


@query("ext_stream_counts")
def ext_stream_counts(spark, sf):
    """Hourly counts by type of event: closed windows, and those still open at the end."""
    path, delay = write_landing(spark, sf)
    cleaned = st.clean_stream(st.stream_events(spark, path, FILES_PER_DELIVERY), delay)
    counted = st.hourly_counts(cleaned)
    return st.all_counts(
        spark, st.write_available(counted, new_folder(spark, "counted"), new_folder(spark, "counting"))
    )


# --- segments ----------------------------------------------------------------


@query("seg_scale")
def seg_scale(spark, sf):
    return _rounded(sg.prepared_features(features_of(spark, sf)))


@query("seg_assign")
def seg_assign(spark, sf):
    return segments_of(spark, sf).select("visitorid", "cluster")


@query("seg_kmeans")
def seg_kmeans(spark, sf):
    return sg.segment_users(features_of(spark, sf))


@query("seg_relabel")
def seg_relabel(spark, sf):
    """Segments by label: mean activity rises with the label."""
    segments = sg.segment_users(features_of(spark, sf))
    return ag.cluster_profile(segments)


@query("seg_project_2d")
def seg_project_2d(spark, sf):
    return fitted(spark, sf).plane


@query("seg_dispersion")
def seg_dispersion(spark, sf):
    return sg.dispersion(seg_project_2d(spark, sf))


@query("seg_size_sweep")
def seg_size_sweep(spark, sf):
    """Synthetic features for ever larger tables, grouped around fitted centres."""
    names = [f"f{j}" for j in range(6)]
    result = None
    for table, key in (("customer", "c_custkey"), ("part", "p_partkey"), ("orders", "o_orderkey")):
        made = pinned(tables.synthetic_features(ad.table(spark, sf, table), key))
        centers = sg.fit_centers(made, starts=3, columns=names)
        labelled = sg.assign_nearest(made, centers, names)
        sizes = labelled.groupBy("cluster").agg(F.count(F.lit(1)).alias("filas"))
        sizes = sizes.withColumn("tabla", F.lit(table))
        result = sizes if result is None else result.unionByName(sizes)
    return result


# --- fitted models -----------------------------------------------------------


@dataclass
class Fitted:
    """Split, indices and models of one log."""

    spark: SparkSession
    sf: str

    @cached_property
    def split(self):
        train, test = split_of(self.spark, self.sf)
        return pinned(train), test

    @cached_property
    def indexed(self):
        return index_train(self.split[0])

    @cached_property
    def known(self):
        return pinned(sp.known_in_train(self.split[1], self.indexed.cells))

    @cached_property
    def als(self):
        return rec.fit_als(self.indexed.cells, factors=FACTORS)

    @cached_property
    def lists(self):
        return pinned(recommend_all(self.ranking, self.indexed, self.known, TOP_N))

    @cached_property
    def ranking(self):
        return ranking_of(self.als, self.indexed)

    @cached_property
    def fixed_ranking(self):
        """The same layout over the event factors, whose products are exact."""
        users, items = self.event_factors
        by_user = self.indexed.users.join(users.withColumnRenamed("id", "u_idx"), "u_idx")
        by_item = self.indexed.items.join(items.withColumnRenamed("id", "i_idx"), "i_idx")
        return RankIndex(by_user, by_item, self.indexed.seen)

    @property
    def n_items(self):
        return self.indexed.items.agg(F.count(F.lit(1))).scalar()

    @cached_property
    def positives(self):
        """One positive per train event, with the columns that identify it."""
        users, items = self.indexed.users, self.indexed.items
        events = self.split[0].select(
            "visitorid", "itemid", "timestamp", "event",
            F.col("transactionid").cast("bigint").alias("tx"),
        )
        joined = events.join(users, "visitorid").join(items, "itemid")
        return pinned(joined.select("u_idx", "i_idx", "timestamp", "event", "tx"))

    def training_pairs(self, epoch=0):
        key = ["u_idx", "i_idx", "timestamp", "event", "tx"]
        return ng.training_pairs(
            self.positives, self.indexed.seen, self.n_items, key, TRAIN_NEGATIVES, epoch=epoch
        )

    @cached_property
    def test_pairs(self):
        users, items = self.indexed.users, self.indexed.items
        joined = self.known.join(users, "visitorid").join(items, "itemid")
        return pinned(joined.select("u_idx", "i_idx"))

    @cached_property
    def plain_als(self):
        """Factors under the plain objective."""
        cells = self.indexed.cells
        return im.fit_implicit(cells, self.indexed.users.count(), self.indexed.items.count(), FACTORS)

    @cached_property
    def plane(self):
        """All users in the plane."""
        return pinned(nb.neighbour_map(pinned(segments_of(self.spark, self.sf))))

    @cached_property
    def eval_negatives(self):
        return pinned(
            ng.evaluation_negatives(
                self.test_pairs, self.indexed.seen, self.n_items, EVAL_NEGATIVES
            )
        )

    @cached_property
    def ranker(self):
        n_users = self.indexed.users.count()
        return nn.fit_neural(self.positives, n_users, self.indexed.items.count(), EPOCHS, TRAIN_NEGATIVES)

    @cached_property
    def event_factors(self):
        events = self.positives
        return (
            pinned(fixed.event_factors(events, "u_idx")),
            pinned(fixed.event_factors(events, "i_idx")),
        )


# Fits take long, so queries share them: one for each state of the input files. The first query
# that needs a fit makes it.
_FITTED: dict[tuple, Fitted] = {}


def _state_of_inputs(spark: SparkSession, sf: str) -> tuple:
    """Name, size and time of the files that the larger log is made from."""
    found = []
    for name in ("orders", "lineitem"):
        files_ = spark.read.format("binaryFile").load(f"{sf}/{name}.parquet")
        found += [tuple(r) for r in files_.select("path", "length", "modificationTime").collect()]
    return tuple(sorted(found))


def fitted(spark: SparkSession, sf: str) -> Fitted:
    key = (spark.sparkContext.applicationId, sf, _state_of_inputs(spark, sf))
    if key not in _FITTED:
        _FITTED.clear()
        _FITTED[key] = Fitted(spark, sf)
    return _FITTED[key]


# What must hold for fitted models, over their whole output.


def _lists_hold(spark, sf, lists):
    """Per user: items in the list, gaps in its ranks, and seen items in it."""
    seen = fitted(spark, sf).split[0].select("visitorid", "itemid").distinct().withColumn("_seen", F.lit(1))
    joined = lists.join(seen, ["visitorid", "itemid"], "left")
    return joined.groupBy("visitorid").agg(
        F.count(F.lit(1)).alias("recomendados"),
        (F.max("rank") - F.count_distinct("rank")).cast("bigint").alias("huecos"),
        F.count("_seen").alias("vistos"),
    )


@query("rec_topn_batch_holds")
def rec_topn_batch_holds(spark, sf):
    return _lists_hold(spark, sf, rec_topn_batch(spark, sf))


@query("rec_topn_user_holds")
def rec_topn_user_holds(spark, sf):
    return _lists_hold(spark, sf, rec_topn_user(spark, sf))


@query("rec_sample_export_holds")
def rec_sample_export_holds(spark, sf):
    return _lists_hold(spark, sf, rec_sample_export(spark, sf))


@query("rec_als_holds")
def rec_als_holds(spark, sf):
    """Rows of factors for each side, and rows with a number missing or not finite."""
    bad = ~F.forall("features", lambda x: F.abs(x) < float("inf")) | (F.size("features") != FACTORS)
    return (
        rec_als_fit(spark, sf)
        .groupBy("tipo")
        .agg(
            F.count_distinct("id").alias("ids"),
            F.count(F.lit(1)).alias("filas"),
            F.count_if(F.coalesce(bad, F.lit(True))).alias("malas"),
        )
    )


@query("rec_neural_holds")
def rec_neural_holds(spark, sf):
    """Scored pairs, and scores outside of 0 to 1."""
    fine = F.coalesce(F.col("score").between(0, 1), F.lit(False))
    return rec_neural_rank(spark, sf).agg(
        F.count(F.lit(1)).alias("pares"), F.count_if(~fine).alias("fuera")
    )


@query("rec_neural_loss_holds")
def rec_neural_loss_holds(spark, sf):
    """Epochs, losses that are no numbers, and whether the last loss is below the first."""
    losses = fitted(spark, sf).ranker.losses
    rows = [(epoch, loss) for epoch, loss in enumerate(losses)]
    table = spark.createDataFrame(rows, "epoca int, perdida double")
    last, first = F.max_by("perdida", "epoca"), F.min_by("perdida", "epoca")
    return table.agg(
        F.count(F.lit(1)).alias("epocas"),
        F.count_if(~(F.col("perdida") < float("inf"))).alias("malas"),
        (last < first).alias("baja"),
    )


@query("seg_kmeans_holds")
def seg_kmeans_holds(spark, sf):
    """Users, and those that are nearer to another centre than to their own."""
    features = features_of(spark, sf)
    centers = sg.fit_centers(sg.prepared_features(features))
    labelled = sg.label_users(features, centers).select("visitorid", "cluster")
    scaled = sg.prepared_features(features).join(labelled, "visitorid")
    values = [F.col(c) for c in FEATURE_COLUMNS]
    distances = F.array(*[fn.squared_distance(values, center) for center in centers])
    far = F.element_at(distances, F.col("cluster") + 1) > F.array_min(distances)
    return scaled.agg(F.count(F.lit(1)).alias("usuarios"), F.count_if(far).alias("lejos"))


@query("seg_relabel_holds")
def seg_relabel_holds(spark, sf):
    """Segments, users, and centres that are quieter than the one with the label before."""
    features = features_of(spark, sf)
    centers = sg.fit_centers(sg.prepared_features(features))
    falls = sum(sum(a) > sum(b) for a, b in zip(centers, centers[1:]))
    sizes = ag.cluster_sizes(sg.label_users(features, centers))
    return sizes.agg(
        F.count(F.lit(1)).alias("segmentos"),
        F.sum("usuarios").alias("usuarios"),
        F.lit(falls).cast("bigint").alias("caidas"),
    )


@query("seg_project_2d_holds")
def seg_project_2d_holds(spark, sf):
    """Users of the map, and those without a place."""
    lost = F.col("x").isNull() | F.col("y").isNull() | F.isnan("x") | F.isnan("y")
    return seg_project_2d(spark, sf).agg(
        F.count_distinct("visitorid").alias("usuarios"), F.count_if(lost).alias("perdidos")
    )


@query("seg_dispersion_holds")
def seg_dispersion_holds(spark, sf):
    return seg_dispersion(spark, sf).select("cluster", "usuarios", "porcentaje")


@query("ext_popularity")
def ext_popularity(spark, sf):
    """The popular list for visitors without a row in train; order keys stand for visitors."""
    train = fitted(spark, sf).indexed
    visitors = ad.table(spark, sf, "orders").select(F.col("o_orderkey").alias("visitorid"))
    return rec.popular_for_new(visitors, train.users, rec.popular_items(train.cells, TOP_N))


@query("rec_als_fit")
def rec_als_fit(spark, sf):
    model = fitted(spark, sf).als
    users = model.userFactors.withColumn("tipo", F.lit("usuario"))
    return users.unionByName(model.itemFactors.withColumn("tipo", F.lit("producto")))


@query("rec_als_plain_fit")
def rec_als_plain_fit(spark, sf):
    """Factors with the weight as confidence and one regularisation for all rows."""
    model = fitted(spark, sf).plain_als
    users = model.userFactors.withColumn("tipo", F.lit("usuario"))
    return users.unionByName(model.itemFactors.withColumn("tipo", F.lit("producto")))


@query("rec_als_plain_holds")
def rec_als_plain_holds(spark, sf):
    """Items, and those whose normal equations are off by more than a ten-thousandth."""
    fit = fitted(spark, sf)
    model = fit.plain_als
    rest = im.normal_equations(fit.indexed.cells, model.itemFactors, model.userFactors, "i_idx", "u_idx")
    return rest.agg(
        F.count(F.lit(1)).alias("productos"), F.count_if(~(F.col("residuo") < 1e-4)).alias("malos")
    )


@query("rec_topn_user")
def rec_topn_user(spark, sf):
    """The list of one user: the one with the lowest id."""
    fit = fitted(spark, sf)
    one = sp.limit_test_users(fit.indexed.users.select("visitorid"), 1)
    return recommend_all(fit.ranking, fit.indexed, one, TOP_N)


@query("rec_topn_batch")
def rec_topn_batch(spark, sf):
    fit = fitted(spark, sf)
    return recommend_all(fit.ranking, fit.indexed, fit.indexed.users, TOP_N)


@query("rec_sample_export")
def rec_sample_export(spark, sf):
    fit = fitted(spark, sf)
    return rec.sample_recommendations(fit.ranking, fit.indexed.users, SAMPLE_USERS, TOP_N)


@query("rec_topn_fixed")
def rec_topn_fixed(spark, sf):
    """Lists of all users under fixed factors."""
    fit = fitted(spark, sf)
    return recommend_all(fit.fixed_ranking, fit.indexed, fit.indexed.users, TOP_N)


@query("rec_neg_train")
def rec_neg_train(spark, sf):
    return fitted(spark, sf).training_pairs()


@query("rec_neg_eval")
def rec_neg_eval(spark, sf):
    return fitted(spark, sf).eval_negatives


@query("rec_neg_shortfall")
def rec_neg_shortfall(spark, sf):
    return ng.training_shortfall(fitted(spark, sf).training_pairs(), TRAIN_NEGATIVES)


@query("rec_neg_epochs")
def rec_neg_epochs(spark, sf):
    """Negatives of two epochs, each drawn anew."""
    fit = fitted(spark, sf)
    epochs = [fit.training_pairs(epoch).filter("label = 0") for epoch in (0, 1)]
    return epochs[0].unionByName(epochs[1]).select("u_idx", "i_idx", "epoch")


@query("rec_neural_rank")
def rec_neural_rank(spark, sf):
    """Scores of the second ranker for every test pair."""
    fit = fitted(spark, sf)
    return fit.ranker.score(fit.test_pairs)


@query("rec_score_pairs")
def rec_score_pairs(spark, sf):
    fit = fitted(spark, sf)
    return rec.score_pairs(fit.indexed.seen, *fit.event_factors)


# --- fixed lists and evaluation ----------------------------------------------


def fixed_lists(spark, sf, score=None):
    train, _ = fitted(spark, sf).split
    return fixed.fixed_recommendations(train, fixed.by_weight() if score is None else score, TOP_N)


@query("rank_recs")
def rank_recs(spark, sf):
    return fixed_lists(spark, sf)


@query("sort_recs_user")
def sort_recs_user(spark, sf):
    """One user's list, that of the lowest id."""
    lists = pinned(fixed_lists(spark, sf))
    lowest = lists.agg(F.min("visitorid")).first()[0]
    return rec.recommendations_of(lists, lowest)


@query("rec_users")
def rec_users(spark, sf):
    return rec.users_with_recommendations(fixed_lists(spark, sf))


@query("eval_full")
def eval_full(spark, sf):
    return _rounded_metrics(ev.full_metrics(fitted(spark, sf).known, fixed_lists(spark, sf), TOP_N))


@query("eval_full_als")
def eval_full_als(spark, sf):
    fit = fitted(spark, sf)
    return ev.metrics_of_places(fit.ranking.places(fit.known), TOP_N)


@query("eval_places")
def eval_places(spark, sf):
    """The place of every test item in the catalogue under fixed factors, by counting."""
    fit = fitted(spark, sf)
    return fit.fixed_ranking.places(fit.known)


@query("eval_full_counted")
def eval_full_counted(spark, sf):
    return _rounded_metrics(ev.metrics_of_places(eval_places(spark, sf), TOP_N))


@query("eval_hits_user")
def eval_hits_user(spark, sf):
    return ev.user_hits(fitted(spark, sf).known, fixed_lists(spark, sf), TOP_N)


@query("join_hits_segments")
def join_hits_segments(spark, sf):
    segments = segments_of(spark, sf)
    return ag.hits_with_segments(eval_hits_user(spark, sf), segments)


@query("agg_hit_by_cluster")
def agg_hit_by_cluster(spark, sf):
    segments = segments_of(spark, sf)
    rates = ag.hit_rate_by_cluster(eval_hits_user(spark, sf), segments, TOP_N)
    return rates.withColumn("hit_rate@10", F.round("`hit_rate@10`", 6))


@query("agg_hit_by_cluster_als")
def agg_hit_by_cluster_als(spark, sf):
    """With fitted lists and fitted segments."""
    fit = fitted(spark, sf)
    segments = sg.segment_users(features_of(spark, sf))
    return ag.hit_rate_by_cluster(ev.user_hits(fit.known, fit.lists, TOP_N), segments, TOP_N)


def _sampled_scores(spark, sf, score):
    """Scores of the true pairs and of their negatives under one scorer."""
    fit = fitted(spark, sf)
    negatives = fit.eval_negatives.select(
        "u_idx", F.col("i_idx").alias("true_idx"), F.col("neg_idx").alias("i_idx")
    )
    scored = score(negatives).select(
        "u_idx", F.col("true_idx").alias("i_idx"), F.col("i_idx").alias("neg_idx"), "score"
    )
    return score(fit.test_pairs), scored


@query("eval_sampled")
def eval_sampled(spark, sf):
    factors = fitted(spark, sf).event_factors
    scores = _sampled_scores(spark, sf, lambda pairs: rec.score_pairs(pairs, *factors))
    return _rounded_metrics(ev.sampled_metrics(*scores, TOP_N))


def _als_sampled(spark, sf):
    model = fitted(spark, sf).als
    return ev.sampled_metrics(
        *_sampled_scores(
            spark, sf, lambda p: rec.score_pairs(p, model.userFactors, model.itemFactors)
        ),
        TOP_N,
    )


def _ranker_sampled(spark, sf):
    fit = fitted(spark, sf)
    return ev.sampled_metrics(
        *_sampled_scores(spark, sf, fit.ranker.score), TOP_N
    )


@query("eval_sampled_als")
def eval_sampled_als(spark, sf):
    return _als_sampled(spark, sf)


@query("eval_sampled_neural")
def eval_sampled_neural(spark, sf):
    return _ranker_sampled(spark, sf)


@query("eval_compare")
def eval_compare(spark, sf):
    """Two fixed scores: summed weight of an item and its number of events."""
    known = fitted(spark, sf).known
    metrics = {
        name: ev.full_metrics(known, fixed_lists(spark, sf, score), TOP_N)
        for name, score in (("peso", fixed.by_weight()), ("eventos", fixed.by_events()))
    }
    compared = ev.compare_models(metrics, "peso", TOP_N)
    return compared.select(
        "metrica",
        F.round("peso", 6).alias("peso"),
        F.round("eventos", 6).alias("eventos"),
        "mejora_eventos_pct",
    )


@query("eval_compare_models")
def eval_compare_models(spark, sf):
    """The two fitted models under the sampled protocol."""
    metrics = {"als": _als_sampled(spark, sf), "neural": _ranker_sampled(spark, sf)}
    return ev.compare_models({m: pinned(t) for m, t in metrics.items()}, "als", TOP_N)


def _rounded_metrics(metrics):
    names = [c for c in metrics.columns if "@" in c]
    return metrics.withColumns({c: F.round(f"`{c}`", 6) for c in names})


# --- measurements ------------------------------------------------------------


def summary_of(spark, sf):
    return perf.summarize_runs(ad.run_times(spark, sf), ["etiqueta", "workers"])


@query("perf_summary")
def perf_summary(spark, sf):
    return summary_of(spark, sf)


@query("perf_speedup")
def perf_speedup(spark, sf):
    return perf.speedup(summary_of(spark, sf), ["etiqueta"])


@query("perf_weak_eff")
def perf_weak_eff(spark, sf):
    return perf.weak_efficiency(summary_of(spark, sf), ["etiqueta"])


def _speedups(spark, sf):
    return perf.speedup(ad.scaling_times(spark, sf), ["etiqueta"])


@query("perf_amdahl_fit")
def perf_amdahl_fit(spark, sf):
    return perf.amdahl_fit(_speedups(spark, sf), ["etiqueta"])


@query("perf_amdahl_point")
def perf_amdahl_point(spark, sf):
    points = perf.amdahl_points(_speedups(spark, sf))
    return points.select(
        "etiqueta", "workers", "speedup", "fraccion_secuencial", "speedup_limite"
    )


@query("perf_weak_linear")
def perf_weak_linear(spark, sf):
    return perf.weak_linear_fit(ad.run_times(spark, sf), ["etiqueta"])


@query("perf_best_config")
def perf_best_config(spark, sf):
    return perf.best_configurations(summary_of(spark, sf), "etiqueta")


@query("perf_stage_share")
def perf_stage_share(spark, sf):
    return perf.stage_shares(ad.stage_times(spark, sf))


@query("perf_batch_latency")
def perf_batch_latency(spark, sf):
    return perf.batch_latency(ad.batch_runs(spark, sf))


@query("perf_load_stats")
def perf_load_stats(spark, sf):
    return perf.load_statistics(ad.request_log(spark, sf))


@query("perf_balance")
def perf_balance(spark, sf):
    return perf.worker_balance(ad.task_log(spark, sf))


# Parallel resources given to each tool of the comparison.
TOOL_RESOURCES = {"1-URGENT": 1, "2-HIGH": 2, "3-MEDIUM": 4, "4-NOT SPECIFIED": 4, "5-LOW": 1}


@query("perf_tool_stages")
def perf_tool_stages(spark, sf):
    times = ad.stage_times(spark, sf)
    return perf.tool_stages(times, ["O", "F", "P"], "1-URGENT", TOOL_RESOURCES)


@query("perf_hotspots")
def perf_hotspots(spark, sf):
    return perf.hotspots(ad.call_times(spark, sf))


@query("perf_breakeven")
def perf_breakeven(spark, sf):
    return perf.breakeven(ad.variant_times(spark, sf))
