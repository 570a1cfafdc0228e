"""Hard negatives: rows of other labels that score just below an anchor's positives.

Anchors are clustered by direction. For a cluster, the angle between a candidate and the
cluster's centre, less the largest angle of a member, bounds the inner product of the candidate
with every member: |u||c| cos(that angle). Candidates are sorted by this bound once for all
members; each member walks the shared list and stops where the bound is below what it still
needs, which certifies that nothing behind can enter its result.

Spark deals the work in cells: a block of anchors with its clusters meets a slice of the
candidates. Both have a bounded number of numbers, so neither the driver nor a task holds all
anchors or all candidates; what cells find is merged by windows over a few rows of each anchor.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rastro.llm.common import pinned

#: Numbers of the vectors of a slice of candidates, and of a block of anchors.
SLICE_NUMBERS, BLOCK_NUMBERS = 4_000_000, 500_000
#: Candidates that make a slice of their own worthwhile, if cores are free.
LEAST_SLICE = 4_096
#: Centres are fitted on the anchors with the least hashes, so many at most; about so many
#: anchors share a centre, of which there are so many at most.
SAMPLE, MEMBERS, CENTRES, ROUNDS = 4_096, 32, 64, 8
#: Candidates that a walk looks at in its first step and in any step; steps double in between.
FIRST_STEP, LAST_STEP = 128, 2_048
#: Members that walk side by side.
SIDE_BY_SIDE = 256
#: Relative error allowed for in a bound.
SLACK = 1e-7

FOUND = "anchor_id long, target long, vec_id long, score long"
#: A target above every score: the best rows of all.
TOP = (1 << 63) - 1


def whole_vectors(df: DataFrame, key: str, vector: str, label: str, scale: int) -> DataFrame:
    """id, label and v = floor(scale * x) of the rows that take part."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    )
    whole = F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    present = F.col(key).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull()
    return df.filter(present & finite).select(
        F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"), whole.alias("v")
    )


def _unit(vectors: np.ndarray) -> np.ndarray:
    floats = vectors.astype(np.float64)
    norms = np.linalg.norm(floats, axis=1, keepdims=True)
    return np.divide(floats, norms, out=np.zeros_like(floats), where=norms > 0)


def centres_of(vectors: np.ndarray) -> np.ndarray:
    """Directions of the clusters of a sample: k-means on the unit sphere."""
    units = _unit(vectors)
    centres = units[: max(1, min(CENTRES, len(units) // MEMBERS))].copy()
    for _ in range(ROUNDS):
        nearest = (units @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, units)
        moved = _unit(sums)
        centres = np.where(moved.any(axis=1, keepdims=True), moved, centres)
    return centres


def _matrix(column, width: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


def _clustered(anchors: DataFrame, centres: np.ndarray) -> DataFrame:
    def assign(batches):
        for batch in batches:
            units = _unit(_matrix(batch.column(2), centres.shape[1]))
            nearest = (units @ centres.T).argmax(axis=1)
            yield batch.append_column("centre", pa.array(nearest, pa.int32()))

    return anchors.select("id", "label", "v").mapInArrow(assign, "id long, label long, v array<long>, centre int")


def _blocks(sizes: dict[int, int], most: int, centres: int) -> tuple[list[int], list[int], int]:
    """For each centre its first block and its number of blocks, and how many blocks there are.
    Small clusters share a block, a large one is split."""
    first, parts, block, free = [0] * centres, [1] * centres, -1, 0
    for centre in range(centres):
        size = sizes.get(centre, 0)
        if size > most:
            first[centre], parts[centre] = block + 1, -(-size // most)
            block, free = block + parts[centre], 0
        else:
            if size > free:
                block, free = block + 1, most
            first[centre], free = max(block, 0), free - size
    return first, parts, block + 1


class _Best:
    """The k best candidates of each target: higher scores first, ties to the smaller id."""

    def __init__(self, lows: np.ndarray, k: int) -> None:
        self.k, self.need = k, lows.copy()
        self.ids = [np.zeros(0, np.int64)] * len(lows)
        self.scores = [np.zeros(0, np.int64)] * len(lows)

    def add(self, target: int, ids: np.ndarray, scores: np.ndarray) -> None:
        ids = np.concatenate([self.ids[target], ids])
        scores = np.concatenate([self.scores[target], scores])
        keep = np.lexsort((ids, -scores))[: self.k]
        self.ids[target], self.scores[target] = ids[keep], scores[keep]
        if len(keep) == self.k:
            self.need[target] = max(self.need[target], self.scores[target][-1])


def walk(bounds, ids, labels, vectors, norms, of, anchor_ids, anchor_labels, anchors, highs, best, same):
    """Targets walk candidates, which are sorted by bound, downwards.

    Target t belongs to the anchor ``of[t]`` and wants the best scores up to ``highs[t]``. It
    stops where no bound reaches what it needs; returns the number of scores worked out.
    """
    active, at, step, looked = np.arange(len(of)), 0, FIRST_STEP, 0
    while at < len(ids):
        active = active[norms[of[active]] * bounds[at] + SLACK * norms[of[active]] >= best.need[active]]
        if not len(active):
            break
        some = slice(at, at + step)
        mine, row = np.unique(of[active], return_inverse=True)
        scores = (anchors[mine] @ vectors[some].T).astype(np.int64, copy=False)
        looked += scores.size
        fits = (labels[some] == anchor_labels[mine][:, None]) == same
        fits &= ids[some] != anchor_ids[mine][:, None]
        wanted = fits[row]
        wanted &= scores[row] <= highs[active][:, None]
        wanted &= scores[row] >= best.need[active][:, None]
        for i in np.flatnonzero(wanted.any(axis=1)).tolist():
            there = np.flatnonzero(wanted[i])
            best.add(int(active[i]), ids[some][there], scores[row[i]][there])
        at, step = at + step, min(2 * step, LAST_STEP)
    return looked


def _cell(width: int, centres: np.ndarray, k: int, percent: int, same: bool):
    """Anchors (id, label, v, centre, targets) against candidates (id, label, v)."""

    def search(candidates: pa.Table, members: pa.Table) -> pa.Table:
        out: list[tuple[int, int, np.ndarray, np.ndarray]] = []
        if candidates.num_rows and members.num_rows:
            ids, labels = candidates["id"].to_numpy(), candidates["label"].to_numpy()
            vectors, anchors = _matrix(candidates["v"], width), _matrix(members["v"], width)
            anchor_ids, anchor_labels = members["id"].to_numpy(), members["label"].to_numpy()
            targets = members["targets"].to_pylist()
            sizes = np.linalg.norm(vectors.astype(np.float64), axis=1)
            norms = np.linalg.norm(anchors.astype(np.float64), axis=1)
            largest = int(np.abs(vectors).max(initial=0)) * int(np.abs(anchors).max(initial=0)) * width
            if largest < 1 << 53:  # floats hold every sum exactly
                vectors, anchors = vectors.astype(np.float64), anchors.astype(np.float64)
            units, centre_of = _unit(vectors), members["centre"].to_numpy()
            for centre in np.unique(centre_of).tolist():
                own = np.flatnonzero(centre_of == centre)
                ways = _unit(anchors[own])[norms[own] > 0] @ centres[centre]
                widest = np.arccos(np.clip(ways.min(initial=1.0), -1, 1))
                angles = np.arccos(np.clip(units @ centres[centre], -1, 1)) - widest
                bounds = sizes * np.cos(np.maximum(angles, 0))
                order = np.argsort(-bounds, kind="stable")
                listed = ids[order], labels[order], vectors[order]
                slack = SLACK * sizes.max(initial=0)
                for low in range(0, len(own), SIDE_BY_SIDE):
                    some = own[low : low + SIDE_BY_SIDE]
                    of = np.repeat(np.arange(len(some)), [len(targets[i]) for i in some])
                    highs = np.array([t for i in some for t in targets[i]], np.int64)
                    floor = np.int64(-TOP) if same else (percent * highs + 99) // 100
                    best = _Best(np.broadcast_to(floor, highs.shape).astype(np.int64), k)
                    walk(
                        bounds[order] + slack, *listed, norms[some], of, anchor_ids[some],
                        anchor_labels[some], anchors[some], highs, best, same,
                    )
                    for t, high in enumerate(highs.tolist()):
                        if len(best.ids[t]):
                            out.append((int(anchor_ids[some][of[t]]), high, best.ids[t], best.scores[t]))
        counts = [len(o[2]) for o in out]
        empty = np.zeros(0, np.int64)
        return pa.table(
            {
                "anchor_id": pa.array(np.repeat(np.array([o[0] for o in out], np.int64), counts)),
                "target": pa.array(np.repeat(np.array([o[1] for o in out], np.int64), counts)),
                "vec_id": pa.array(np.concatenate([empty, *(o[2] for o in out)])),
                "score": pa.array(np.concatenate([empty, *(o[3] for o in out)])),
            }
        )

    return search


class _Search:
    """All rows of one vector length and their clustered anchors."""

    def __init__(self, rows: DataFrame, width: int, every: int) -> None:
        self.width = width
        # A repeated anchor is searched once, with the first of its rows.
        anchors = rows.filter(F.col("id") % every == 0).groupBy("id").agg(F.min(F.struct("label", "v")).alias("_row"))
        anchors = pinned(anchors.select("id", "_row.*"))
        sample = anchors.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).toArrow()
        self.found_any = sample.num_rows > 0
        if not self.found_any:
            return
        self.centres = centres_of(_matrix(sample["v"], width))
        clustered = pinned(_clustered(anchors, self.centres))
        sizes = {r["centre"]: r["n"] for r in clustered.groupBy("centre").agg(F.count(F.lit(1)).alias("n")).collect()}
        first, parts, self.blocks = _blocks(sizes, max(1, BLOCK_NUMBERS // max(1, width)), len(self.centres))
        at = F.col("centre") + 1
        pick = lambda values: F.element_at(F.array(*map(F.lit, values)), at)
        self.anchors = clustered.withColumn("block", pick(first) + F.pmod(F.xxhash64("id"), pick(parts)).cast("int"))
        n = rows.count()
        cores = rows.sparkSession.sparkContext.defaultParallelism
        self.slices = max(-(-n * max(1, width) // SLICE_NUMBERS), min(cores, -(-n // LEAST_SLICE)))
        self.rows = rows.withColumn("slice", F.pmod(F.monotonically_increasing_id(), F.lit(self.slices)).cast("int"))

    def best(self, targets: DataFrame | None, k: int, percent: int, same: bool) -> DataFrame:
        """FOUND, ``rank``: of each anchor and target the k best rows of its label, or of others."""
        if targets is None:
            anchors = self.anchors.withColumn("targets", F.array(F.lit(TOP)))
        else:
            anchors = self.anchors.join(targets, "id")
        across = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        left = self.rows.select("id", "label", "v", "slice", across(self.blocks).alias("block"))
        right = anchors.select("id", "label", "v", "centre", "targets", "block", across(self.slices).alias("slice"))
        cells = left.groupBy("block", "slice").cogroup(right.groupBy("block", "slice"))
        found = cells.applyInArrow(_cell(self.width, self.centres, k, percent, same), FOUND)
        order = Window.partitionBy("anchor_id", "target").orderBy(F.col("score").desc(), "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(
    df: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    every: int = 100,
    positives: int = 5,
    negatives: int = 5,
    percent: int = 80,
    scale: int = 256,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are rows whose id is divisible by ``every``; their positives the ``positives`` best
    other rows of their label; for each positive come the ``negatives`` best rows of other labels
    that score at most as much and at least ``percent`` per cent of it. Scores are inner products
    of floor(``scale`` * x), exact while a hundred times a score fits into 64 bits; ties go to the
    smaller id. All is exact: the lists are walked until nothing behind can matter.

    Rows with a null id, label or vector, or with null, NaN or infinite components, take no part.
    Vectors meet those of the same length only. Rows of an anchor's own id are no positives or
    negatives of it; a repeated anchor is searched once, with its smallest label and vector;
    another repeated id counts each time. A positive that scores below 0 has no negatives. An
    empty table, or one without anchors, gives an empty one. Other columns are not read.
    """
    spark = df.sparkSession
    table = pinned(whole_vectors(df, key, vector, label, scale))
    widths = [r[0] for r in table.select(F.size("v")).distinct().collect()]
    mined = []
    for width in sorted(widths):
        search = _Search(table.filter(F.size("v") == width), width, every)
        if not search.found_any:
            continue
        close = pinned(search.best(None, positives, percent, True))
        wanted = close.filter("score >= 0").groupBy(F.col("anchor_id").alias("id"))
        targets = wanted.agg(F.collect_set("score").alias("targets"))
        hard = search.best(targets, negatives, percent, False).select(
            "anchor_id",
            F.col("target").alias("positive_score"),
            "rank",
            F.col("vec_id").alias("negative_id"),
            F.col("score").alias("negative_score"),
        )
        pairs = close.select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
        mined.append(pairs.join(hard, ["anchor_id", "positive_score"]))
    if not mined:
        return spark.createDataFrame(
            [],
            "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long",
        )
    return reduce(DataFrame.unionByName, mined).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
