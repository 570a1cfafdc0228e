"""Exact nearest neighbours by inner product, pruned by segment statistics.

A vector is cut into 1, 2, 4 … equal segments; of each segment it keeps mean and deviation. By
Cauchy and Schwarz, the squared distance of two segments of length L is at least
L((m - m')² + (s - s')²), and in the same way their inner product is at most L(mm' + ss'). So
each resolution bounds the distance from below, and with the norms the score from above. Bounds
are worked out coarse to fine, each for what the one before left, and exact integer scores for
the survivors only.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rastro.llm.common import pinned

#: Numbers of all queries of a block together; a block is sent to every task.
BLOCK_NUMBERS = 4_000_000
#: Cells of a table of bounds that a task holds at a time.
BOUND_CELLS = 2_000_000

RESULT = "query_id long, vec_id long, score long"


def quantised(df: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """Vectors of whole numbers floor(scale * x); those with null or non-finite parts go."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    )
    whole = F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    return df.filter(F.col(vector).isNotNull() & F.col(key).isNotNull() & finite).select(
        F.col(key).cast("long").alias("id"), whole.alias("v")
    )


def _levels(width: int) -> list[np.ndarray]:
    """Borders of the segments, coarse to fine."""
    levels, parts = [], 1
    while parts <= max(1, width // 4):
        levels.append(np.unique(np.linspace(0, width, parts + 1).astype(np.int64)))
        parts *= 2
    return levels


def _statistics(vectors: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """Means and deviations of the segments, times the root of the segment's length, so that
    the product of two rows is the bound of the inner product."""
    lengths = np.diff(borders)
    sums = np.add.reduceat(vectors, borders[:-1], axis=1)
    squares = np.add.reduceat(vectors * vectors, borders[:-1], axis=1)
    means = sums / lengths
    spread = np.sqrt(np.maximum(squares / lengths - means * means, 0))
    return np.concatenate([means, spread], axis=1) * np.sqrt(np.concatenate([lengths, lengths]))


class _Best:
    """The k highest scores of each query so far, ties to the smaller id."""

    def __init__(self, queries: int, k: int, least: np.ndarray) -> None:
        self.k, self.least = k, least.copy()
        self.scores: list[np.ndarray] = [np.zeros(0, np.int64)] * queries
        self.ids: list[np.ndarray] = [np.zeros(0, np.int64)] * queries

    def add(self, query: int, ids: np.ndarray, scores: np.ndarray) -> None:
        ids = np.concatenate([self.ids[query], ids])
        scores = np.concatenate([self.scores[query], scores])
        keep = np.lexsort((ids, -scores))[: self.k]
        self.ids[query], self.scores[query] = ids[keep], scores[keep]
        if len(keep) == self.k:
            self.least[query] = max(self.least[query], float(scores[keep][-1]))


def _search(query_ids, queries, least, k, ids, vectors, best=None):
    """Adds to ``best`` what these candidates hold for these queries."""
    best = best or _Best(len(query_ids), k, least)
    if not len(ids) or not queries.shape[1]:
        for q in range(len(query_ids) if not queries.shape[1] else 0):
            other = ids != query_ids[q]
            best.add(q, ids[other], np.zeros(int(other.sum()), np.int64))
        return best
    floats, targets = vectors.astype(np.float64), queries.astype(np.float64)
    levels = _levels(queries.shape[1])
    of_candidates = [_statistics(floats, b) for b in levels]
    of_queries = [_statistics(targets, b) for b in levels]
    slack = 1e-9 * (np.abs(targets).max(initial=0) * np.abs(floats).max(initial=0) * floats.shape[1] + 1)
    step = max(1, BOUND_CELLS // max(1, len(ids)))
    for low in range(0, len(query_ids), step):
        some = slice(low, low + step)
        coarse = of_queries[0][some] @ of_candidates[0].T
        for q, bounds in enumerate(coarse, low):
            alive = np.flatnonzero((bounds >= best.least[q] - slack) & (ids != query_ids[q]))
            for mine, theirs in zip(of_queries[1:], of_candidates[1:]):
                if len(alive) <= k:
                    break
                alive = alive[theirs[alive] @ mine[q] >= best.least[q] - slack]
            if len(alive):
                best.add(q, ids[alive], vectors[alive] @ queries[q])
    return best


def _blocks(table: DataFrame, condition) -> list[tuple[np.ndarray, np.ndarray]]:
    """The queries of one vector length in blocks of bounded size, read one after the other."""
    queries = table.filter(condition)
    n, width = queries.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    each = max(1, BLOCK_NUMBERS // max(1, width or 1))
    count = -(-n // each)
    for block in range(count):
        rows = queries.filter(F.pmod(F.xxhash64("id"), F.lit(count)) == block) if count > 1 else queries
        got = rows.toPandas()
        yield (
            got["id"].to_numpy(np.int64),
            np.array(got["v"].tolist(), np.int64).reshape(len(got), -1),
        )


def top_k(
    df: DataFrame, k: int = 5, every: int = 50, scale: int = 256, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` highest inner products of each query with every
    row but its own, ties to the smaller id. Queries are rows whose id is divisible by ``every``.

    Components become floor(``scale`` * x); scores are exact while they fit into 64 bits.
    Vectors that are null or hold null, NaN or infinite components, and rows without an id, take
    no part. Vectors are compared with those of the same length only; empty ones score 0. A
    repeated id is a candidate each time, but never for a query of its own id; a repeated query
    is searched once, with the numbers of its first row in their order. An empty table, or one
    without queries, gives an empty table. Columns other than ``key`` and ``vector`` are not read.

    Each block of queries is sent to all tasks; a block has at most ``BLOCK_NUMBERS`` numbers.
    A few candidates give each query a score that its k-th best at least reaches, so that no
    task starts without a threshold; this settles nothing but what need not be looked at.
    """
    spark = df.sparkSession
    table = pinned(quantised(df, key, vector, scale))
    widths = [r[0] for r in table.select(F.size("v")).distinct().collect()]
    found = []
    for width in sorted(widths):
        same = table.filter(F.size("v") == width)
        for query_ids, queries in _blocks(same, F.col("id") % every == 0):
            order = np.lexsort((*queries.T[::-1], query_ids)) if width else np.argsort(query_ids)
            query_ids, first = np.unique(query_ids[order], return_index=True)
            found.append(_search_all(spark, same, query_ids, queries[order][first], width, k))
    if not found:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _search_all(spark, table, query_ids, queries, width, k) -> DataFrame:
    seed = table.limit(4 * k + 64).toPandas()
    start = _search(
        query_ids,
        queries,
        np.full(len(query_ids), -np.inf),
        k,
        *np_columns(seed["id"], seed["v"].tolist(), width),
    )
    shared = spark.sparkContext.broadcast((query_ids, queries, start.least))

    def search(batches):
        query_ids, queries, least = shared.value
        best = _Best(len(query_ids), k, least)
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            values = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            _search(query_ids, queries, least, k, *np_columns(ids, values, width), best=best)
        sizes = [len(x) for x in best.ids]
        if sum(sizes):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(query_ids, sizes), pa.int64()),
                    pa.array(np.concatenate(best.ids), pa.int64()),
                    pa.array(np.concatenate(best.scores), pa.int64()),
                ],
                names=["query_id", "vec_id", "score"],
            )

    return table.mapInArrow(search, RESULT)


def np_columns(ids, values, width):
    ids = np.asarray(ids, np.int64)
    return ids, np.asarray(values, np.int64).reshape(len(ids), width)
