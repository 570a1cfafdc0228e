"""A plane map that keeps neighbours together: a neighbour graph, and a layout fitted on it.

The graph comes from NN-descent. Points are sorted along a few random directions and compared
within short runs of each order; then every point introduces its neighbours, and those it is a
neighbour of, to one another, and each keeps its nearest, until hardly anything changes. A point
takes part in a bounded number of introductions in each round, so a hub costs no more than
others, and no task sees more than a run or the acquaintances of a point.

The layout starts from two principal components. In each step graph neighbours attract and some
random points repel one another, and all points move at once: joins and sums by point.
"""

from __future__ import annotations

from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rastro.operators.index import index_ids
from rastro.operators.transform import log_features
from rastro.schemas import FEATURE_COLUMNS
from rastro.session import new_folder, pinned, remove_folder

NEIGHBOURS = 15
#: Random directions, and points of a run that are compared with one another.
DIRECTIONS, RUN = 4, 64
POINTS_PER_TASK = 50_000
#: Rounds end when fewer than this share of the neighbours is new.
ROUNDS, CHANGE = 8, 0.005
STEPS, REPEL, RATE, FARTHEST_MOVE = 30, 5, 0.25, 4.0
#: Weights of the mean pull of the neighbours and of the mean push of others.
PULL, PUSH = 2.0, 5.0
#: Deviation of the first places along the wider axis, times the root of the number of points:
#: a point has about the room of one unit, the length at which pulls are strongest.
ROOM = 0.75
PAIRS = "a long, b long, d double"


def _squares(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return ((left[:, None, :] - right[None, :, :]) ** 2).sum(axis=2)


def _nearest_within(ids: np.ndarray, vectors: np.ndarray, k: int):
    """(a, b, squared distance): the k nearest others of each, among these."""
    squares = _squares(vectors, vectors)
    squares[np.arange(len(ids)), np.arange(len(ids))] = np.inf
    k = min(k, len(ids) - 1)
    if k < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    near = np.argpartition(squares, k - 1, axis=1)[:, :k] if k < len(ids) - 1 else np.argsort(squares, axis=1)[:, :k]
    return np.repeat(ids, k), ids[near].ravel(), np.take_along_axis(squares, near, 1).ravel()


def _batch(found) -> pa.RecordBatch:
    a, b, d = (np.concatenate(part) for part in zip(*found)) if found else (np.zeros(0, np.int64),) * 2 + (np.zeros(0),)
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(d)], names=["a", "b", "d"])


def _along(points: DataFrame, direction: np.ndarray, k: int, tasks: int) -> DataFrame:
    """Near pairs within runs of the order along a direction."""
    place = sum(F.col("v")[j] * F.lit(float(x)) for j, x in enumerate(direction))
    ordered = points.withColumn("_at", place).repartitionByRange(tasks, "_at", "id").sortWithinPartitions("_at", "id")

    def compare(batches):
        ids, vectors = np.zeros(0, np.int64), np.zeros((0, len(direction)))
        for batch in batches:
            ids = np.concatenate([ids, batch.column(0).to_numpy()])
            vectors = np.concatenate([vectors, batch.column(1).flatten().to_numpy().reshape(-1, len(direction))])
            found = []
            # Runs overlap by half, so that neighbours at a border meet.
            while len(ids) >= 2 * RUN:
                found.append(_nearest_within(ids[:RUN], vectors[:RUN], k))
                ids, vectors = ids[RUN // 2 :], vectors[RUN // 2 :]
            yield _batch(found)
        yield _batch([_nearest_within(ids, vectors, k)])

    return ordered.select("id", "v").mapInArrow(compare, PAIRS)


def _best(pairs: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("a").orderBy("d", "b")
    ranked = pairs.dropDuplicates(["a", "b"]).withColumn("place", F.row_number().over(order))
    return ranked.filter(F.col("place") <= k)


def neighbour_graph(points: DataFrame, k: int = NEIGHBOURS, seed: int = 42, rounds: int = ROUNDS) -> DataFrame:
    """(a, b, d, place): about the k nearest other points of each point, and their squared
    distance. ``points`` is a written table (id, v) of vectors of one length.

    An approximation: recall against all pairs is measured in the tests.
    """
    spark = points.sparkSession
    n, width = points.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    if n < 2:
        return spark.createDataFrame([], PAIRS + ", place int")
    tasks = max(1, min(spark.sparkContext.defaultParallelism, n // (4 * RUN)), ceil(n / POINTS_PER_TASK))
    draw = np.random.default_rng(seed)
    pairs = None
    for _ in range(DIRECTIONS):
        along = _along(points, draw.normal(size=width), k, tasks)
        pairs = along if pairs is None else pairs.unionByName(along)
    graph, folder = _written(_best(pairs, k))
    for number in range(rounds):
        better, fresh = _written(_best(_introduced(graph, points, k, number).unionByName(graph.select("a", "b", "d")), k))
        new = better.join(graph, ["a", "b"], "left_anti").count()
        remove_folder(spark, folder)
        graph, folder = better, fresh
        if new <= CHANGE * n * k:
            break
    return graph


def _written(table: DataFrame) -> tuple[DataFrame, str]:
    path = new_folder(table.sparkSession, "map")
    table.write.parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path), path


def _introduced(graph: DataFrame, points: DataFrame, k: int, number: int) -> DataFrame:
    """Pairs among the acquaintances of each point: its neighbours, and at most k of those it is
    a neighbour of, others in each round."""
    chance = Window.partitionBy("p").orderBy(F.xxhash64("p", "m", F.lit(number)), "m")
    back = graph.select(F.col("b").alias("p"), F.col("a").alias("m"))
    back = back.withColumn("_r", F.row_number().over(chance)).filter(F.col("_r") <= k).drop("_r")
    known = graph.select(F.col("a").alias("p"), F.col("b").alias("m")).unionByName(back)
    known = known.unionByName(points.select(F.col("id").alias("p"), F.col("id").alias("m"))).distinct()
    vectors = points.select(F.col("id").alias("m"), "v")
    circles = known.join(vectors, "m").groupBy("p").agg(F.collect_list("m").alias("m"), F.collect_list("v").alias("v"))

    def introduce(batches):
        for batch in batches:
            found = []
            for ids, own in zip(batch.column(1), batch.column(2)):
                ids = ids.values.to_numpy()
                found.append(_nearest_within(ids, own.values.flatten().to_numpy().reshape(len(ids), -1), k))
            yield _batch(found)

    return circles.mapInArrow(introduce, PAIRS)


def layout(points: DataFrame, graph: DataFrame, steps: int = STEPS, seed: int = 42) -> DataFrame:
    """(id, x, y): places in the plane for points with ids from 0 without gaps."""
    n = points.count()
    if n < 2:
        return points.select("id", F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))
    vectors = points.select("id", array_to_vector("v").alias("_v"))
    plane = PCA(k=2, inputCol="_v", outputCol="_p").fit(vectors).transform(vectors)
    plane = plane.select("id", vector_to_array("_p").alias("_p")).select("id", F.col("_p")[0].alias("x"), F.col("_p")[1].alias("y"))
    spread = plane.agg(F.struct(F.avg("x").alias("mx"), F.avg("y").alias("my"), F.stddev_pop("x").alias("s"))).scalar()
    scale = F.when(F.col("_s.s") > 0, ROOM * sqrt(n) / F.col("_s.s")).otherwise(1.0)
    start = plane.withColumn("_s", spread).select(
        "id", ((F.col("x") - F.col("_s.mx")) * scale).alias("x"), ((F.col("y") - F.col("_s.my")) * scale).alias("y")
    )
    spark = points.sparkSession
    state, folder = _written(start)
    pulls = graph.select("a", "b").unionByName(graph.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    pulls = pinned(pulls.withColumn("pull", F.lit(True)))
    for step in range(steps):
        other = F.pmod(F.xxhash64("id", F.lit(seed), F.lit(step), "_k"), F.lit(n))
        pushes = points.select("id", F.explode(F.sequence(F.lit(1), F.lit(REPEL))).alias("_k")).select(
            F.col("id").alias("a"), other.alias("b"), F.lit(False).alias("pull")
        )
        moved, fresh = _written(_moved(state, pulls.unionByName(pushes.filter("a <> b")), RATE * (1 - step / steps)))
        remove_folder(spark, folder)
        state, folder = moved, fresh
    return state


def _moved(state: DataFrame, forces: DataFrame, rate: float) -> DataFrame:
    """Every point moved along the mean of its forces, by a bounded length."""
    here = state.select(F.col("id").alias("a"), F.col("x").alias("ax"), F.col("y").alias("ay"))
    there = state.select(F.col("id").alias("b"), F.col("x").alias("bx"), F.col("y").alias("by"))
    met = forces.join(here, "a").join(there, "b")
    dx, dy = F.col("ax") - F.col("bx"), F.col("ay") - F.col("by")
    square = dx * dx + dy * dy
    # Slope of log(1 + d²) for neighbours, and of its counterpart for others.
    force = F.when(F.col("pull"), -2 / (1 + square)).otherwise(2 / ((0.01 + square) * (1 + square)))

    def mean(way):
        pull, push = (F.coalesce(F.avg(F.when(kind, force * way)), F.lit(0.0)) for kind in (F.col("pull"), ~F.col("pull")))
        return PULL * pull + PUSH * push

    sums = met.groupBy("a").agg(mean(dx).alias("fx"), mean(dy).alias("fy"))
    length = F.sqrt(F.col("fx") ** 2 + F.col("fy") ** 2)
    bound = F.when(length > FARTHEST_MOVE, FARTHEST_MOVE / length).otherwise(1.0) * F.lit(rate)
    joined = state.join(sums.withColumnRenamed("a", "id"), "id", "left")
    move = lambda f: F.coalesce(F.col(f) * bound, F.lit(0.0))
    return joined.select("id", (F.col("x") + move("fx")).alias("x"), (F.col("y") + move("fy")).alias("y"))


def kept_neighbours(graph: DataFrame, places: DataFrame, k: int = NEIGHBOURS) -> float:
    """Share of graph neighbours that are among the k nearest in the plane, too."""
    flat = pinned(places.select("id", F.array("x", "y").alias("v")))
    in_plane = neighbour_graph(flat, k).select("a", "b")
    return graph.join(in_plane, ["a", "b"], "left_semi").count() / max(1, graph.count())


def distinct_points(segments: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(id, v, and the features): the distinct log1p features of users, numbered from 0."""
    columns = FEATURE_COLUMNS if columns is None else columns
    prepared = log_features(segments, columns)
    hashed = prepared.select(*columns).distinct().withColumn("_h", F.xxhash64(*columns))
    hashed = pinned(hashed)
    ids = index_ids(hashed, "_h", "id")
    found = hashed.join(ids, "_h")
    return pinned(found.select("id", F.array(*[F.col(c).cast("double") for c in columns]).alias("v"), *columns))


def neighbour_map(
    segments: DataFrame, k: int = NEIGHBOURS, steps: int = STEPS, seed: int = 42, columns: list[str] | None = None
) -> DataFrame:
    """(visitorid, cluster, x, y): all users in a plane where users with like features lie
    together. Users with the same features share a place, so the map is fitted on the distinct
    ones."""
    columns = FEATURE_COLUMNS if columns is None else columns
    points = distinct_points(segments, columns)
    graph = neighbour_graph(points.select("id", "v"), k, seed)
    places = layout(points.select("id", "v"), graph, steps, seed)
    placed = points.select("id", *columns).join(places, "id").drop("id")
    prepared = log_features(segments, columns)
    return prepared.join(placed, columns).select("visitorid", "cluster", "x", "y")
