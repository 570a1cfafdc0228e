"""Ranking of the whole catalogue: lists of unseen items, and places of given items.

Items lie in slices of bounded size, those with long vectors first. By Cauchy and Schwarz no
item behind a place scores more than the user's norm times the item norm at that place, so a
scan stops for a user when nothing behind can enter the list, or beat the given item. Seen items
are masked in the same pass, whatever their number: a task meets those of one slice at a time.

One slice after the other goes to all tasks; users that are done pass the later ones untouched.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rastro.session import new_folder, pinned, remove_folder, written

#: Bytes of a slice's vectors, which are broadcast; items scored in one step; users side by side.
SLICE_BYTES = 64 << 20
STEP_ITEMS = 4096
SIDE_BY_SIDE = 256
#: So many asked users are looked up by their ids; more are joined.
FEW = 1000
USERS_PER_TASK = 10_000
#: Relative error allowed for in a bound.
SLACK = 1e-6

LISTS = "visitorid long, rank int, itemid long, score double"
STATE = "visitorid long, features array<double>, itemids array<long>, i_idx array<long>, scores array<double>"


class _Slice:
    """Items of a slice by falling norm."""

    def __init__(self, table: pa.Table, single: bool) -> None:
        ids = table["i_idx"].to_numpy()
        vectors = _matrix(table["features"])
        norms = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
        order = np.lexsort((ids, -norms))
        self.ids, self.norms = ids[order], norms[order]
        self.names = table["itemid"].to_numpy()[order]
        # Single precision when the factors have it: half the bytes, and scores are rounded to it.
        self.vectors = vectors[order].astype(np.float32 if single else np.float64)
        self.by_id = np.argsort(self.ids, kind="stable")
        self.single = single

    def places(self, ids: np.ndarray) -> np.ndarray:
        """Places of items by id; -1 if not in this slice."""
        if not len(self.ids):
            return np.full(len(ids), -1)
        at = np.minimum(np.searchsorted(self.ids, ids, sorter=self.by_id), len(self.ids) - 1)
        found = self.by_id[at]
        return np.where(self.ids[found] == ids, found, -1)

    def rounded(self, scores: np.ndarray) -> np.ndarray:
        """Products differ in their last bits with the shape they are worked out in."""
        return scores.astype(np.float32).astype(np.float64) if self.single else scores


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1) if n else np.zeros((0, 0))


def _flat(column) -> tuple[np.ndarray, np.ndarray]:
    """(row, value) of a column of lists; null is empty."""
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(column)), sizes), column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)


def _scan(items: _Slice, users: np.ndarray, seen: tuple[np.ndarray, np.ndarray], needs, visit) -> None:
    """Visits (first place, rows, scores) of steps while a user still needs them; seen are NaN.

    ``needs()`` gives the score that each user's items must reach.
    """
    norms = np.sqrt(np.einsum("ij,ij->i", users, users))
    rows, places = seen[0], items.places(seen[1])
    rows, places = rows[places >= 0], places[places >= 0]
    order = np.argsort(places, kind="stable")
    rows, places = rows[order], places[order]
    for low in range(0, len(items.ids), STEP_ITEMS):
        high = min(low + STEP_ITEMS, len(items.ids))
        active = np.flatnonzero(norms * items.norms[low] * (1 + SLACK) >= needs())
        if not len(active):
            return
        scores = items.rounded(users[active] @ items.vectors[low:high].T.astype(np.float64))
        own = slice(*np.searchsorted(places, [low, high]))
        where = np.full(len(users), -1)
        where[active] = np.arange(len(active))
        masked = where[rows[own]]
        scores[masked[masked >= 0], places[own][masked >= 0] - low] = np.nan
        visit(low, active, scores)


class _Lists:
    """The n best items of some users so far."""

    def __init__(self, n: int, ids, names, scores) -> None:
        self.n, self.ids, self.names, self.scores = n, ids, names, scores
        self.need = np.array([s[-1] if len(s) == n else -np.inf for s in scores])

    def visit(self, items: _Slice, low: int, rows: np.ndarray, scores: np.ndarray) -> None:
        fits = scores >= self.need[rows][:, None]
        for k in np.flatnonzero(fits.any(axis=1)).tolist():
            there = np.flatnonzero(fits[k])
            own, row = scores[k][there], rows[k]
            if len(there) > self.n:
                least = np.partition(own, -self.n)[-self.n]
                there, own = there[own >= least], own[own >= least]
            own = np.concatenate([self.scores[row], own])
            ids = np.concatenate([self.ids[row], items.ids[low + there]])
            names = np.concatenate([self.names[row], items.names[low + there]])
            best = np.lexsort((ids, -own))[: self.n]
            self.scores[row], self.ids[row], self.names[row] = own[best], ids[best], names[best]
            if len(best) == self.n:
                self.need[row] = self.scores[row][-1]


class RankIndex:
    """Users, seen pairs and sliced items of one model, laid out for ranking.

    ``users`` has visitorid, u_idx and features, ``items`` itemid, i_idx and features, and
    ``seen`` u_idx and i_idx. Users lie in the order of their ids, so that few of them are found
    without a scan. ``close`` deletes the tables.
    """

    def __init__(self, users: DataFrame, items: DataFrame, seen: DataFrame) -> None:
        spark = self.spark = users.sparkSession
        kind = users.schema["features"].dataType.elementType.typeName()
        self.single = kind == "float"
        parallel = spark.sparkContext.defaultParallelism
        own = items.select("itemid", "i_idx", F.col("features").cast("array<double>").alias("features"))
        n, width = own.agg(F.count(F.lit(1)), F.max(F.size("features"))).first()
        self.slices = max(1, ceil(n * (width or 0) * (4 if self.single else 8) / SLICE_BYTES))
        if self.slices > 1:
            norm = F.aggregate("features", F.lit(0.0), lambda s, x: s + x * x)
            own = own.repartitionByRange(self.slices, norm.desc(), "i_idx")
        self._paths: list[str] = []
        self.items = self._written(own.withColumn("slice", F.spark_partition_id() if self.slices > 1 else F.lit(0)))
        vectors = users.select("visitorid", "u_idx", F.col("features").cast("array<double>").alias("features"))
        self.users = self._written(vectors.repartitionByRange(parallel, "visitorid").sortWithinPartitions("visitorid"))
        self.n_users = self.users.count()
        pairs = seen.select("u_idx", "i_idx").join(self.users.select("u_idx", "visitorid"), "u_idx")
        if self.slices > 1:
            pairs = pairs.join(self.items.select("i_idx", "slice"), "i_idx")
        else:
            pairs = pairs.withColumn("slice", F.lit(0))
        pairs = pairs.select("visitorid", "i_idx", "slice")
        self.seen = self._written(
            pairs.repartitionByRange(parallel, "visitorid", "i_idx").sortWithinPartitions("visitorid")
        )
        self._sent = None

    def _written(self, table: DataFrame) -> DataFrame:
        path = new_folder(self.spark, "ranking")
        self._paths.append(path)
        return written(table, path)

    def close(self) -> None:
        if self._sent is not None:
            self._sent.destroy()
            self._sent = None
        for path in self._paths:
            remove_folder(self.spark, path)

    def _slice(self, number: int):
        """The broadcast items of a slice. A single one stays for further questions."""
        if self._sent is not None and self.slices == 1:
            return self._sent
        table = self.items.filter(F.col("slice") == number).select("itemid", "i_idx", "features").toArrow()
        sent = self.spark.sparkContext.broadcast(_Slice(table, self.single))
        if self._sent is not None:
            self._sent.destroy()
        self._sent = sent
        return sent

    def _asked(self, visitors: DataFrame) -> tuple[DataFrame, DataFrame, int]:
        """Users and seen pairs of the visitors, and the tasks that their ranking is spread to."""
        distinct = visitors.select(F.col("visitorid").cast("long").alias("visitorid")).distinct()
        few = [r[0] for r in distinct.limit(FEW + 1).collect()]
        if len(few) <= FEW:
            among = F.col("visitorid").isin([v for v in few if v is not None])
            tasks = max(1, min(self.spark.sparkContext.defaultParallelism, ceil(len(few) / (SIDE_BY_SIDE // 2))))
            return self.users.filter(among), self.seen.filter(among), tasks
        tasks = max(self.spark.sparkContext.defaultParallelism, ceil(self.n_users / USERS_PER_TASK))
        distinct = pinned(distinct)
        return tuple(t.join(distinct, "visitorid", "left_semi") for t in (self.users, self.seen)) + (tasks,)

    @staticmethod
    def _seen_of(seen: DataFrame, number: int) -> DataFrame:
        """Seen items of one slice by user: never more than a slice has."""
        own = seen.filter(F.col("slice") == number)
        return own.groupBy("visitorid").agg(F.collect_list("i_idx").alias("seen"))

    def lists(self, visitors: DataFrame, n: int = 10) -> DataFrame:
        """(visitorid, rank, itemid, score): the n best items that each visitor has not seen,
        the lower index first on a tie. Visitors that the model does not know get no row."""
        asked, seen, tasks = self._asked(visitors)
        nothing = [F.array().cast(f"array<{t}>").alias(c) for c, t in (("itemids", "long"), ("i_idx", "long"), ("scores", "double"))]
        state, folder = asked.select("visitorid", "features", *nothing), None
        for number in range(self.slices):
            sent, last = self._slice(number), number == self.slices - 1
            joined = state.join(self._seen_of(seen, number), "visitorid", "left").repartition(tasks)
            stepped = joined.mapInArrow(_list_step(sent, n, last), LISTS if last else STATE)
            if last and folder is None:
                return stepped
            path = new_folder(self.spark, "lists")
            state = written(stepped, path)
            if folder is not None:
                remove_folder(self.spark, folder)
            folder = path
        return state

    def places(self, test: DataFrame) -> DataFrame:
        """(visitorid, itemid, rank) of (visitorid, itemid) rows: 1 and the number of unseen
        items above the given one, ties to the lower index; null for one that was seen. No list
        is made: items are counted, slice by slice, until nothing behind can score as much."""
        given = test.select(F.col("visitorid").cast("long").alias("visitorid"), F.col("itemid").cast("long").alias("itemid"))
        _, seen, tasks = self._asked(given)
        own = self.items.select("itemid", F.col("i_idx").alias("true_idx"), F.col("features").alias("true_vector"))
        pairs = pinned(given.join(self.users.select("visitorid", "features"), "visitorid").join(own, "itemid"))
        counted = None
        for number in range(self.slices):
            sent = self._slice(number)
            joined = pairs.join(self._seen_of(seen, number), "visitorid", "left").repartition(tasks)
            columns = joined.select("visitorid", "itemid", "features", "true_idx", "true_vector", "seen")
            counts = columns.mapInArrow(_count_step(sent), "visitorid long, itemid long, above long, seen boolean")
            counts = counts if self.slices == 1 else pinned(counts)
            counted = counts if counted is None else counted.unionByName(counts)
        if self.slices > 1:
            counted = counted.groupBy("visitorid", "itemid").agg(F.sum("above").alias("above"), F.bool_or("seen").alias("seen"))
        rank = F.when(~F.col("seen"), F.col("above") + 1)
        return counted.select("visitorid", "itemid", rank.alias("rank"))


def _list_step(sent, n: int, last: bool):
    def step(batches):
        items = sent.value
        for batch in batches:
            for at in range(0, batch.num_rows, SIDE_BY_SIDE):
                rows = batch.slice(at, SIDE_BY_SIDE)
                users = _matrix(rows.column(1))
                lists = _Lists(
                    n, *([np.array(v, kind) for v in rows.column(c).to_pylist()] for c, kind in ((3, np.int64), (2, np.int64), (4, np.float64)))
                )
                _scan(items, users, _flat(rows.column(5)), lambda: lists.need, lambda *a: lists.visit(items, *a))
                yield _ranked(rows, lists) if last else _carried(rows, lists)

    return step


def _ranked(rows: pa.RecordBatch, lists: _Lists) -> pa.RecordBatch:
    sizes = np.array([len(s) for s in lists.scores], np.int64)
    ranks = [np.arange(1, k + 1) for k in sizes]
    values = [
        pa.array(np.repeat(rows.column(0).to_numpy(), sizes), pa.int64()),
        pa.array(np.concatenate([np.zeros(0, np.int32), *ranks]), pa.int32()),
        pa.array(np.concatenate([np.zeros(0, np.int64), *lists.names]), pa.int64()),
        pa.array(np.concatenate([np.zeros(0), *lists.scores]), pa.float64()),
    ]
    return pa.RecordBatch.from_arrays(values, names=["visitorid", "rank", "itemid", "score"])


def _carried(rows: pa.RecordBatch, lists: _Lists) -> pa.RecordBatch:
    values = [
        rows.column(0),
        rows.column(1),
        *(pa.array(list(v), pa.list_(k)) for v, k in ((lists.names, pa.int64()), (lists.ids, pa.int64()), (lists.scores, pa.float64()))),
    ]
    return pa.RecordBatch.from_arrays(values, names=["visitorid", "features", "itemids", "i_idx", "scores"])


def _count_step(sent):
    def step(batches):
        items = sent.value
        for batch in batches:
            for at in range(0, batch.num_rows, SIDE_BY_SIDE):
                rows = batch.slice(at, SIDE_BY_SIDE)
                users, true = _matrix(rows.column(2)), rows.column(3).to_numpy()
                scores = items.rounded(np.einsum("ij,ij->i", users, _matrix(rows.column(4))))
                owner, seen = _flat(rows.column(5))
                known = np.zeros(len(true), bool)
                known[owner[seen == true[owner]]] = True
                above = np.zeros(len(true), np.int64)

                def visit(low, own, found):
                    ids, least = items.ids[low : low + found.shape[1]], scores[own][:, None]
                    more = (found > least) | ((found == least) & (ids < true[own][:, None]))
                    above[own] += more.sum(axis=1)

                _scan(items, users, (owner, seen), lambda: scores, visit)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), pa.array(above), pa.array(known)],
                    names=["visitorid", "itemid", "above", "seen"],
                )

    return step
