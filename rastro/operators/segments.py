"""User segments: scaling, K-Means, stable labels, nearest centre, 2-D map."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from rastro.functions.columns import squared_distance
from rastro.operators.split import sample_users
from rastro.operators.transform import log_features
from rastro.schemas import FEATURE_COLUMNS
from rastro.session import pinned

#: Centres that move less than this are at rest.
TOLERANCE = 1e-4
DIGITS = 9


def scale_features(features: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Zero mean and unit population deviation; a constant column gives 0."""
    columns = FEATURE_COLUMNS if columns is None else columns
    moments = [
        f(c).alias(f"{name}_{c}")
        for c in columns
        for name, f in (("avg", F.avg), ("std", F.stddev_pop))
    ]
    stats = features.agg(F.struct(*moments)).scalar()
    centred = features.withColumn("_s", stats)
    scaled = {
        c: F.coalesce(
            F.try_divide(F.col(c) - F.col(f"_s.avg_{c}"), F.col(f"_s.std_{c}")), F.lit(0.0)
        )
        for c in columns
    }
    return centred.withColumns(scaled).drop("_s")


def prepared_features(features: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """log1p and scaling, the space in which segments are formed."""
    return scale_features(log_features(features, columns), columns)


def fit_centers(
    scaled: DataFrame,
    k: int = 6,
    seed: int = 42,
    starts: int = 10,
    columns: list[str] | None = None,
    iterations: int = 300,
) -> list[list[float]]:
    """Centres of the best of several K-Means starts, quietest segment first.

    Most users of a click log share their feature values with many others, so the fit runs on
    distinct vectors weighted by their number of users; the cost is the same sum. One pass over
    the vectors serves all starts: each task sums up its vectors by start and nearest centre. A
    start whose centres no longer move is left out of the next pass. First centres are drawn one
    by one, in proportion to weight and squared distance, by a hash of the vector, so that they
    do not depend on the layout.
    """
    columns = FEATURE_COLUMNS if columns is None else columns
    weighted = scaled.groupBy(*columns).agg(F.count(F.lit(1)).cast("double").alias("_users"))
    vectors = pinned(weighted.select(*[F.col(c).cast("double") for c in columns], "_users"))
    vectors.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        found = _first_centers(vectors, k, seed, starts, len(columns))
        moving = set(range(starts))
        for _ in range(iterations):
            sums, counts, _ = _pass(vectors, {s: found[s] for s in moving})
            for s in list(moving):
                full = counts[s] > 0
                moved = found[s].copy()
                moved[full] = sums[s][full] / counts[s][full, None]
                shift = ((moved - found[s]) ** 2).sum(axis=1).max(initial=0)
                found[s] = moved
                if shift <= TOLERANCE**2:
                    moving.discard(s)
            if not moving:
                break
        # What the last centres cost; the passes know the cost of those before.
        _, _, cost = _pass(vectors, dict(enumerate(found)))
    finally:
        vectors.unpersist()
    best = min(range(starts), key=lambda s: (cost[s], s))
    # Sums differ in their last digits with the order of the rows.
    return sorted_centers(found[best].round(DIGITS).tolist())


def _first_centers(vectors: DataFrame, k: int, seed: int, starts: int, width: int) -> list[np.ndarray]:
    """Of each start, k vectors drawn by weight times squared distance to those before: the one
    with the least exponential variate, so that tasks send one vector for each start."""
    centers = [np.zeros((0, width)) for _ in range(starts)]

    def draw(batches):
        best = [(np.inf, None)] * starts
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            if not len(x):
                continue
            x, weight = np.ascontiguousarray(x[:, :-1]), x[:, -1]
            for s, own in enumerate(centers):
                chance = weight * _distances(x, own).min(axis=1) if len(own) else weight
                uniform = _uniform(x, seed + s, len(own))
                with np.errstate(divide="ignore"):
                    wait = np.where(chance > 0, -np.log(uniform) / chance, np.inf)
                at = np.lexsort((*x.T[::-1], wait))[0]
                best[s] = min(best[s], (wait[at], x[at].tolist()), key=lambda b: (b[0], b[1] is None, b[1]))
        rows = [(s, wait, at) for s, (wait, at) in enumerate(best) if at is not None]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([r[0] for r in rows], pa.int32()),
                pa.array([r[1] for r in rows], pa.float64()),
                pa.array([r[2] for r in rows], pa.list_(pa.float64())),
            ],
            names=["start", "wait", "center"],
        )

    for _ in range(k):
        drawn = vectors.mapInArrow(draw, "start int, wait double, center array<double>")
        least = drawn.groupBy("start").agg(F.min(F.struct("wait", "center")).alias("least"))
        for row in least.collect():
            # Fewer distinct vectors than centres: the rest have nothing to draw.
            if row.least.wait < np.inf:
                centers[row.start] = np.vstack([centers[row.start], row.least.center])
    return centers


def _uniform(x: np.ndarray, seed: int, step: int) -> np.ndarray:
    """Numbers above 0 and up to 1 that depend on the vectors and the draw alone."""
    bits = (x + 0.0).view(np.uint64)  # -0.0 is 0.0
    mixed = np.full(len(x), (seed * 1_000_003 + step + 1) & (2**64 - 1), np.uint64)
    for column in bits.T:
        mixed = (mixed ^ column) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    mixed = (mixed * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(11)
    return (mixed.astype(np.float64) + 1) / 2.0**53


def _distances(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances, from differences: no two near vectors lose them to rounding."""
    return sum((x[:, j, None] - centers[None, :, j]) ** 2 for j in range(x.shape[1]))


def _pass(vectors: DataFrame, centers: dict[int, np.ndarray]):
    """(sums, weights, cost) by start: of each centre's vectors, and of all."""

    def add(batches):
        totals = {s: [np.zeros((len(c), c.shape[1] + 1)), 0.0] for s, c in centers.items()}
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            weight = x[:, -1].copy()
            x[:, -1] = 1
            for s, own in centers.items():
                distances = _distances(x[:, :-1], own)
                nearest = distances.argmin(axis=1)
                totals[s][1] += float((weight * distances[np.arange(len(x)), nearest]).sum())
                for j in range(x.shape[1]):
                    totals[s][0][:, j] += np.bincount(nearest, weight * x[:, j], len(own))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(totals), pa.int32()),
                pa.array([t[0].tobytes() for t in totals.values()], pa.binary()),
                pa.array([t[1] for t in totals.values()], pa.float64()),
            ],
            names=["start", "sums", "cost"],
        )

    parts = vectors.mapInArrow(add, "start int, sums binary, cost double").toArrow().to_pydict()
    totals = {s: np.zeros((len(c), c.shape[1] + 1)) for s, c in centers.items()}
    costs = dict.fromkeys(centers, 0.0)
    for s, sums, cost in zip(parts["start"], parts["sums"], parts["cost"]):
        totals[s] += np.frombuffer(sums).reshape(totals[s].shape)
        costs[s] += cost
    return {s: t[:, :-1] for s, t in totals.items()}, {s: t[:, -1] for s, t in totals.items()}, costs


def sorted_centers(centers: list[list[float]]) -> list[list[float]]:
    """Centres by mean activity, so that label 0 is the quietest segment."""
    return sorted(centers, key=lambda center: (sum(center) / len(center), center))


def assign_nearest(
    scaled: DataFrame, centers: list[list[float]], columns: list[str] | None = None
) -> DataFrame:
    """Add ``cluster``: the nearest centre, the lowest label on a tie."""
    columns = FEATURE_COLUMNS if columns is None else columns
    values = [F.col(c) for c in columns]
    distances = F.array(*[squared_distance(values, center) for center in centers])
    first_least = F.array_position("_distances", F.array_min("_distances")) - 1
    return (
        scaled.withColumn("_distances", distances)
        .withColumn("cluster", first_least.cast("int"))
        .drop("_distances")
    )


def label_users(
    features: DataFrame, centers: list[list[float]], columns: list[str] | None = None
) -> DataFrame:
    """The user features as they came, plus ``cluster``.

    ``features`` is read twice, for its means and for its rows: pass a written
    or pinned table.
    """
    columns = FEATURE_COLUMNS if columns is None else columns
    raw = {f"_raw_{c}": F.col(c) for c in columns}
    prepared = prepared_features(features.withColumns(raw), columns)
    labelled = assign_nearest(prepared, centers, columns)
    back = [F.col(f"_raw_{c}").alias(c) if c in columns else F.col(c) for c in features.columns]
    return labelled.select(*back, "cluster")


def segment_users(
    features: DataFrame,
    k: int = 6,
    seed: int = 42,
    starts: int = 10,
    columns: list[str] | None = None,
) -> DataFrame:
    """User features plus their K-Means segment."""
    centers = fit_centers(prepared_features(features, columns), k, seed, starts, columns)
    return label_users(features, centers, columns)


def project_2d(
    segments: DataFrame, n: int | None = None, seed: int = 42, columns: list[str] | None = None
) -> DataFrame:
    """Two principal components of all users, for a plane map; of a seeded sample of ``n``."""
    columns = FEATURE_COLUMNS if columns is None else columns
    sampled = segments
    if n is not None:
        sampled = segments.join(sample_users(segments, n, seed), "visitorid", "left_semi")
    prepared = log_features(sampled, columns)
    vectors = VectorAssembler(inputCols=columns, outputCol="vector").transform(prepared)
    model = PCA(k=2, inputCol="vector", outputCol="plane").fit(vectors)
    plane = vector_to_array("plane")
    return model.transform(vectors).select(
        "visitorid", "cluster", plane[0].alias("x"), plane[1].alias("y")
    )


def dispersion(plane: DataFrame) -> DataFrame:
    """Share of each cluster in the map and its spread along both axes."""
    sizes = plane.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("usuarios"),
        F.stddev_pop("x").alias("std_x"),
        F.stddev_pop("y").alias("std_y"),
    )
    total = plane.agg(F.count(F.lit(1))).scalar()
    share = F.round(100.0 * F.col("usuarios") / F.col("_total"), 1)
    return sizes.withColumn("_total", total).select(
        "cluster", "usuarios", share.alias("porcentaje"), "std_x", "std_y"
    )
