"""Implicit-feedback factors, by blocks.

    Σ c(u,i) (p(u,i) − x·y)² + λ (Σ|x|² + Σ|y|²)

with p = 1 and c = the weight where a user has acted on an item, p = 0 and c = 1 elsewhere, and
one λ for all, whatever their number of actions (``fit_implicit``); or with c = 1 + α·weight and
λ times a row's number of actions, as Spark's ALS has it (``fit_scaled``). One side's rows are
solved while the other side stands still: by conjugate gradients from where they were, or exactly.
Only the cells of a block are walked, rows with equally many side by side, and the cells of nobody
enter through the other side's Gram matrix.

Both sides lie in blocks, ranges of ids with about equally many cells. What a block needs of the
other side does not change, so it is worked out once: a half step sends each block's rows to the
blocks that need them, once each, and then solves every block in one task. It does so for as many
blocks at a time as ``PHASE_BYTES`` allows, so what is on its way does not grow with the input.
Every half step is written to the shared folder; the one before is deleted.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rastro.functions.columns import dot
from rastro.session import new_folder, pinned, remove_folder, written

#: Of the layout: a task holds the cells of a block and the rows they need.
BLOCK_ROWS, BLOCK_CELLS, LEAST_BLOCKS = 50_000, 500_000, 8
#: Of the first draw, which has blocks of its own.
DRAW_ROWS, DRAW_CELLS = 100_000, 2_000_000
#: Ids are counted in so many ranges at most.
RANGES = 1 << 16
#: Rows on their way to the blocks that need them.
PHASE_BYTES = 512 << 20
#: Steps of conjugate gradients in a half step, and at most in the last one, which goes on
#: until no row's residual is above this share of its right side.
STEPS, LAST_STEPS, TOLERANCE = 3, 60, 1e-6
#: Cells that are walked at a time: their rows stay in a core's cache.
WALK = 8_192
ROWS = "key int, side string, block int, ids binary, data binary, gram binary"


def _rows(found: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*found)) if found else [[]] * 6
    kinds = (pa.int32(), pa.string(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
    names = [f.split()[0] for f in ROWS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _entries(batches):
    """(key, side, block, ids, data) of the rows, one by one."""
    for batch in batches:
        for at in range(batch.num_rows):
            yield tuple(batch.column(c)[at].as_py() for c in range(5))


class Cells:
    """The cells of a block by own row: own row, place among the other side's rows it needs,
    weight."""

    def __init__(self, row: np.ndarray, other: np.ndarray, weight: np.ndarray) -> None:
        self.row, self.other, self.weight = row, other, weight

    def pack(self) -> bytes:
        return b"".join([self.row.astype("<i4").tobytes(), self.other.astype("<i4").tobytes(), self.weight.astype("<f4").tobytes()])

    @staticmethod
    def unpack(data: bytes) -> Cells:
        n = len(data) // 12
        return Cells(*(np.frombuffer(data, kind, n, 4 * n * k) for k, kind in enumerate(("<i4", "<i4", "<f4"))))

    def groups(self, n: int):
        """(own rows, places of their cells): rows with equally many cells, ``WALK`` cells of
        them at most or one row."""
        counts = np.bincount(self.row, minlength=n)
        starts, order = np.cumsum(counts) - counts, np.argsort(counts, kind="stable")
        sizes, first = np.unique(counts[order], return_index=True)
        for size, low, high in zip(sizes.tolist(), first, [*first[1:], n]):
            step = max(1, WALK // max(1, size))
            for at in range(low, high, step):
                rows = order[at : min(at + step, high)]
                yield rows, starts[rows][:, None] + np.arange(size)


def _pieces(at: np.ndarray, take: Callable) -> Callable:
    """A walk over what ``take`` makes of the cells: held, or made anew for a row with very many."""
    parts = [at[:, low : low + WALK] for low in range(0, at.shape[1], WALK)]
    held = [take(part) for part in parts] if len(parts) <= 1 else None
    return lambda: iter(held) if held is not None else map(take, parts)


def solve(cells: Cells, others: np.ndarray, gram: np.ndarray, start: np.ndarray, regularization: float, steps: int, tolerance: float = 0.0):
    """(rows, largest relative residual): the rows of a block after some steps of conjugate
    gradients from ``start``."""
    inner, worst = gram + regularization * np.eye(len(gram)), 0.0
    found = np.empty(start.shape)
    for rows, at in cells.groups(len(start)):
        walk = _pieces(at, lambda part: (others[cells.other[part]].astype(np.float64), cells.weight[part].astype(np.float64)))
        found[rows], rest = _descend(walk, inner, start[rows].astype(np.float64), steps, tolerance)
        worst = max(worst, rest)
    return found, worst


def _descend(walk, inner: np.ndarray, x: np.ndarray, steps: int, tolerance: float) -> tuple[np.ndarray, float]:
    def weighed(factors, theirs):
        return (factors[:, None, :] @ theirs)[:, 0, :]

    def product(x):
        total = x @ inner
        for theirs, weight in walk():
            total += weighed((weight - 1) * (theirs @ x[:, :, None])[:, :, 0], theirs)
        return total

    right = np.zeros_like(x)
    for theirs, weight in walk():
        right += weighed(weight, theirs)
    size = np.maximum(np.einsum("ij,ij->i", right, right), 1e-300)
    rest = right - product(x)
    way, square = rest.copy(), np.einsum("ij,ij->i", rest, rest)
    for _ in range(steps):
        if not (square > tolerance**2 * size).any():
            break
        along = product(way)
        curve = np.einsum("ij,ij->i", way, along)
        length = np.divide(square, curve, out=np.zeros_like(square), where=curve > 0)[:, None]
        x += length * way
        rest -= length * along
        fresh = np.einsum("ij,ij->i", rest, rest)
        way = rest + np.divide(fresh, square, out=np.zeros_like(square), where=square > 0)[:, None] * way
        square = fresh
    return x, float(np.sqrt(square / size).max(initial=0.0))


def solve_scaled(cells: Cells, others: np.ndarray, gram: np.ndarray, n: int, regularization: float, alpha: float) -> np.ndarray:
    """The n rows of a block, exactly: confidence 1 + α·|weight|, nothing wanted of weights up to
    0, and λ times the number of those above.

    In the basis in which the Gram matrix is diagonal, and scaled by it, a row's equations are
    1 + Z'EZ, well conditioned whatever the Gram matrix; those with few cells are solved as
    1 + EZZ', one equation for each cell.
    """
    values, turn = np.linalg.eigh(gram)
    width, turned = len(gram), np.empty(others.shape, np.float32)
    for low in range(0, len(others), WALK):
        turned[low : low + WALK] = others[low : low + WALK] @ turn
    found = np.zeros((n, width), np.float32)
    for rows, at in cells.groups(n):
        if not at.shape[1]:
            continue
        wanted = (cells.weight[at] > 0).sum(axis=1)
        base = np.maximum(values, 0)[None, :] + regularization * wanted[:, None]
        scale = (1 / np.sqrt(np.maximum(base, 1e-30))).astype(np.float32)

        def take(part, scale=scale):
            weight = cells.weight[part]
            extra = (alpha * np.abs(weight)).astype(np.float32)
            return turned[cells.other[part]] * scale[:, None, :], extra, np.where(weight > 0, 1 + extra, 0).astype(np.float32)

        if at.shape[1] <= width:
            theirs, extra, right = take(at)
            inner = (theirs * extra[:, :, None]) @ theirs.transpose(0, 2, 1)
            inner[:, np.arange(at.shape[1]), np.arange(at.shape[1])] += 1
            x = (np.linalg.solve(inner, right[:, :, None]).transpose(0, 2, 1) @ theirs)[:, 0, :]
        else:
            inner, right = np.eye(width), 0
            for theirs, extra, share in _pieces(at, take)():
                inner = inner + (theirs * extra[:, :, None]).transpose(0, 2, 1) @ theirs
                right = right + (share[:, None, :] @ theirs)[:, 0, :]
            x = np.linalg.solve(inner, right[:, :, None])[:, :, 0]
        found[rows] = (x * scale) @ turn.T
    return found


class _Side:
    """One side's layout: where its blocks of ids start."""

    def __init__(self, cells: DataFrame, own: str, n: int, blocks: int | None) -> None:
        width = max(1, ceil(n / RANGES))
        counted = cells.groupBy(F.floor(F.col(own) / width).alias("k")).agg(F.count(F.lit(1)).alias("n")).collect()
        weight = np.full(ceil(n / width), width / BLOCK_ROWS)
        for r in counted:
            weight[r["k"]] = max(weight[r["k"]], r["n"] / BLOCK_CELLS)
        upto = np.append(0, np.cumsum(weight))
        self.own, self.n = own, n
        self.blocks = blocks or max(LEAST_BLOCKS, ceil(upto[-1]))
        ends = np.searchsorted(upto, upto[-1] * np.arange(1, self.blocks) / self.blocks) * width
        self.starts = np.concatenate([[0], np.minimum(ends, n), [n]]).astype(np.int64)

    def block(self, ids: np.ndarray) -> np.ndarray:
        """Of blocks without ids the last one starts where the next one does."""
        return np.searchsorted(self.starts[1:-1], ids, side="right")


def _packed(cells: DataFrame, own: _Side, other: _Side, gaps: bool) -> DataFrame:
    """ROWS of one side: its blocks' ids and cells ("c"), and links ("l") that name, for a block
    of the other side, its ids that a block needs. With ``gaps`` only ids with cells have rows."""
    placed = cells.select(F.col(own.own).cast("long"), F.col(other.own).cast("long"), F.col("peso").cast("double"))

    def place(batches):
        for batch in batches:
            key = pa.array(own.block(batch.column(0).to_numpy()), pa.int32())
            yield pa.RecordBatch.from_arrays([key, *batch.columns], names=["key", "own", "other", "peso"])

    def pack(batches):
        parts = [[c.to_numpy() for c in batch.columns[1:]] for batch in batches]
        block = TaskContext.get().partitionId()
        mine, theirs, weight = (np.concatenate(c) for c in zip(*parts)) if parts else (np.zeros(0),) * 3
        mine, theirs = mine.astype(np.int64), theirs.astype(np.int64)
        ids = np.unique(mine) if gaps else np.arange(own.starts[block], own.starts[block + 1])
        needed, place = np.unique(theirs, return_inverse=True)
        order = np.lexsort((place, mine))
        packed = Cells(np.searchsorted(ids, mine[order]), place[order], weight[order]).pack()
        yield _rows([(block, "c", block, ids.astype("<i4").tobytes(), packed, None)])
        their_block = other.block(needed)
        for k in np.unique(their_block).tolist():
            yield _rows([(k, "l", block, needed[their_block == k].astype("<i4").tobytes(), None, None)])

    keyed = placed.mapInArrow(place, "key int, own long, other long, peso double")
    return keyed.repartitionById(own.blocks, "key").mapInArrow(pack, ROWS)


def _laid_out(table: DataFrame, side: _Side, factors: int) -> DataFrame:
    """Rows (id, features) as ROWS of the side's blocks ("f")."""

    def place(batches):
        for batch in batches:
            key = pa.array(side.block(batch.column(0).to_numpy()), pa.int32())
            yield pa.RecordBatch.from_arrays([key, *batch.columns], names=["key", "id", "features"])

    def gather(batches):
        parts = [(b.column(1).to_numpy(), b.column(2).flatten().to_numpy().reshape(-1, factors)) for b in batches]
        block = TaskContext.get().partitionId()
        ids, rows = (np.concatenate(c) for c in zip(*parts)) if parts else (np.zeros(0, np.int64), np.zeros((0, factors)))
        order = np.argsort(ids)
        yield _state(block, ids[order], rows[order])

    rows = table.select(F.col("id").cast("long").alias("id"), F.col("features").cast("array<float>").alias("features"))
    keyed = rows.mapInArrow(place, "key int, id long, features array<float>")
    return keyed.repartitionById(side.blocks, "key").mapInArrow(gather, ROWS)


def _state(block: int, ids: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
    """A solved block with its share of the Gram matrix."""
    rows = rows.astype("<f4")
    exact = rows.astype(np.float64)
    return _rows([(block, "f", block, ids.astype("<i4").tobytes(), rows.tobytes(), (exact.T @ exact).tobytes())])


def _first(spark, blocks: int, n: int, factors: int, seed: int, side: int) -> DataFrame:
    def first(batches):
        for batch in batches:
            for block in batch.column(0).to_pylist():
                draw = np.random.default_rng([seed, side, block])
                rows = draw.normal(0, 0.01, (max(0, -(-(n - block) // blocks)), factors)).astype("<f4")
                yield from _lists(block + blocks * np.arange(len(rows), dtype=np.int64), rows)

    return spark.range(blocks).mapInArrow(first, "id long, features array<float>")


def _lists(ids: np.ndarray, rows: np.ndarray):
    for low in range(0, len(rows), 10_000):
        some = rows[low : low + 10_000]
        places = pa.array(np.arange(0, some.size + 1, rows.shape[1], dtype=np.int32))
        lists = pa.ListArray.from_arrays(places, pa.array(some.ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(ids[low : low + 10_000], pa.int64()), lists], names=["id", "features"])


def _gram(state: DataFrame, factors: int) -> np.ndarray:
    """The Gram matrix of rows (features)."""

    def square(batches):
        total = np.zeros((factors, factors))
        for batch in batches:
            rows = batch.column(0).flatten().to_numpy().reshape(-1, factors).astype(np.float64)
            total += rows.T @ rows
        yield _rows([(0, "g", 0, None, None, total.tobytes())])

    return _summed(state.mapInArrow(square, ROWS).select("gram").collect(), factors)


def _summed(found, factors: int) -> np.ndarray:
    return sum((np.frombuffer(r["gram"]).reshape(factors, factors) for r in found), np.zeros((factors, factors)))


class _Half:
    """Half steps of one side: its blocks, solved against the other side's."""

    def __init__(self, cells: DataFrame, own: _Side, other: _Side, factors: int, gaps: bool) -> None:
        self.own, self.other, self.factors = own, other, factors
        self.side, self.folder = _written(_packed(cells, own, other, gaps))
        links = self.side.filter("side = 'l'").groupBy("block").agg(
            F.sum(F.length("ids") / 4).alias("rows"), F.min("key").alias("low"), F.max("key").alias("high")
        )
        needs = {r["block"]: (r["rows"] * 4 * factors, r["low"], r["high"]) for r in links.collect()}
        #: (first block, last, first of the other side's, last).
        self.phases, held = [], 0.0
        for block in range(own.blocks):
            size, low, high = needs.get(block, (0.0, other.blocks, -1))
            if not self.phases or held and held + size > PHASE_BYTES:
                self.phases.append([block, block, other.blocks, -1])
                held = 0.0
            phase, held = self.phases[-1], held + size
            phase[1:] = [block, min(phase[2], low), max(phase[3], high)]

    def step(self, states: list[DataFrame | None], solver: Callable) -> tuple[DataFrame, str]:
        """The written rows; ``states`` are the own side's, if the solver starts from them, and
        the other side's."""
        start, others = states
        gram = _summed(others.orderBy("block").select("gram").collect(), self.factors)
        path = new_folder(others.sparkSession, "factors")
        for phase in self.phases:
            written(self._phase(start, others, gram, solver, *phase), path, mode="append")
        return others.sparkSession.read.schema(others.schema).parquet(path), path

    def _phase(self, start, others, gram, solver, first: int, last: int, low: int, high: int) -> DataFrame:
        factors = self.factors

        def send(batches):
            links, ids, rows = [], None, None
            for here, s, block, own, data in _entries(batches):
                if s == "f":
                    ids, rows = np.frombuffer(own, "<i4"), np.frombuffer(data, "<f4").reshape(-1, factors)
                else:
                    links.append((here, block, np.frombuffer(own, "<i4")))
            for here, block, wanted in links:
                yield _rows([(block, "o", here, None, rows[np.searchsorted(ids, wanted)].tobytes(), None)])

        def settle(batches):
            got, cells, begin = {}, None, None
            for here, s, block, own, data in _entries(batches):
                if s == "o":
                    got[block] = np.frombuffer(data, "<f4").reshape(-1, factors)
                elif s == "c":
                    block_here, ids, cells = here, np.frombuffer(own, "<i4"), Cells.unpack(data)
                else:
                    begin = np.frombuffer(data, "<f4").reshape(-1, factors)
            theirs = np.concatenate([np.zeros((0, factors), "<f4"), *(got.pop(k) for k in sorted(got))])
            yield _state(block_here, ids, solver(cells, theirs, gram, len(ids) if begin is None else begin))

        mine = self.side.filter(F.col("block").between(first, last))
        together = mine.filter("side = 'c'")
        if start is not None:
            together = together.unionByName(start.filter(F.col("block").between(first, last)))
        if high >= low:
            met = mine.filter("side = 'l'").unionByName(others.filter(F.col("key").between(low, high)))
            sent = met.repartitionById(high - low + 1, F.col("key") - low).mapInArrow(send, ROWS)
            together = together.unionByName(sent)
        return together.repartitionById(last - first + 1, F.col("key") - first).mapInArrow(settle, ROWS)


@dataclass
class ImplicitModel:
    """Factors (id, features) of users and items."""

    userFactors: DataFrame  # noqa: N815 - as in Spark's own model
    itemFactors: DataFrame  # noqa: N815


def _alternate(halves: list[_Half], states: list, order: tuple[int, int], iterations: int, solver_of: Callable) -> ImplicitModel:
    """Half steps of both sides in turn; ``states`` are (written rows, folder) or nothing yet.
    ``solver_of`` gives a solver, and whether it starts from the rows before."""
    spark = halves[0].side.sparkSession
    for number in range(iterations):
        for k in order:
            solver, starts = solver_of(number == iterations - 1 and k == order[-1])
            fresh = halves[k].step([states[k][0] if starts else None, states[1 - k][0]], solver)
            if states[k]:
                remove_folder(spark, states[k][1])
            states[k] = fresh
    for half in halves:
        remove_folder(spark, half.folder)
    found = [pinned(_spread(state, halves[0].factors)) for state, _ in states]
    for _, folder in states:
        remove_folder(spark, folder)
    return ImplicitModel(*found)


def fit_implicit(
    cells: DataFrame,
    n_users: int,
    n_items: int,
    factors: int = 64,
    regularization: float = 0.01,
    iterations: int = 15,
    seed: int = 42,
    blocks: int | None = None,
) -> ImplicitModel:
    """Factors of (u_idx, i_idx, peso), one row for each pair, indices from 0 without gaps.

    The items are solved last, so their normal equations hold (``normal_equations``).
    """
    spark = cells.sparkSession
    draws = blocks or max(LEAST_BLOCKS, ceil(max(n_users, n_items) / DRAW_ROWS), ceil(cells.count() / DRAW_CELLS))
    sides = [_Side(cells, own, n, blocks) for own, n in (("u_idx", n_users), ("i_idx", n_items))]
    halves = [_Half(cells, *pair, factors, False) for pair in (sides, sides[::-1])]
    states = [_written(_laid_out(_first(spark, draws, s.n, factors, seed, k), s, factors)) for k, s in enumerate(sides)]

    def solver_of(last: bool):
        how = (regularization, LAST_STEPS, TOLERANCE) if last else (regularization, STEPS)
        return lambda found, others, gram, start: solve(found, others, gram, start, *how)[0], True

    return _alternate(halves, states, (0, 1), iterations, solver_of)


def fit_scaled(
    cells: DataFrame,
    first_users: DataFrame,
    factors: int = 64,
    regularization: float = 0.01,
    iterations: int = 15,
    alpha: float = 1.0,
    blocks: int | None = None,
) -> ImplicitModel:
    """Factors of (u_idx, i_idx, peso) under the objective of Spark's ALS, from the users' first
    rows (id, features). Indices may have gaps; what has no cells gets no row."""
    most = cells.agg(F.max("u_idx"), F.max("i_idx")).first()
    sides = [_Side(cells, own, n + 1, blocks) for own, n in zip(("u_idx", "i_idx"), most)]
    halves = [_Half(cells, *pair, factors, True) for pair in (sides, sides[::-1])]
    states = [_written(_laid_out(first_users, sides[0], factors)), None]

    def solver_of(last: bool):
        return lambda found, others, gram, n: solve_scaled(found, others, gram, n, regularization, alpha), False

    return _alternate(halves, states, (1, 0), iterations, solver_of)


def _written(table: DataFrame) -> tuple[DataFrame, str]:
    path = new_folder(table.sparkSession, "factors")
    return written(table, path), path


def _spread(state: DataFrame, factors: int) -> DataFrame:
    def spread(batches):
        for _, _, _, ids, data in _entries(batches):
            yield from _lists(np.frombuffer(ids, "<i4").astype(np.int64), np.frombuffer(data, "<f4").reshape(-1, factors))

    return state.mapInArrow(spread, "id long, features array<float>")


def normal_equations(
    cells: DataFrame, own: DataFrame, other: DataFrame, own_key: str, other_key: str, regularization: float = 0.01
) -> DataFrame:
    """(id, residuo): for each row of ``own`` (id, features) the largest entry of A·x − b, against
    that of b; from the cells and factors alone, by joins."""
    width = other.agg(F.max(F.size("features"))).first()[0] or 0
    gram = _gram(other.select("features"), width)
    mine = own.select(F.col("id").alias(own_key), F.col("features").alias("_x"))
    theirs = other.select(F.col("id").alias(other_key), F.col("features").alias("_y"))
    met = cells.select(own_key, other_key, F.col("peso").cast("double")).join(theirs, other_key).join(mine, own_key)
    pull = F.col("peso") - (F.col("peso") - 1) * dot(F.col("_x"), F.col("_y"))
    both = F.concat(
        F.transform("_y", lambda y: y.cast("double") * F.col("_p")),
        F.transform("_y", lambda y: y.cast("double") * F.col("peso")),
    )
    vectors = met.withColumn("_p", pull).select(own_key, array_to_vector(both).alias("_v"))
    sums = vectors.groupBy(own_key).agg(Summarizer.sum(F.col("_v")).alias("_v"))

    def residuals(batches):
        inner = gram + regularization * np.eye(width)
        for batch in batches:
            x = batch.column(1).flatten().to_numpy().astype(float).reshape(-1, width)
            r, b = np.split(batch.column(2).flatten().to_numpy().reshape(-1, 2 * width), 2, axis=1)
            rest = np.abs(r - x @ inner).max(axis=1) / np.maximum(np.abs(b).max(axis=1), 1e-300)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rest)], names=["id", "residuo"])

    joined = sums.join(mine, own_key).select(own_key, "_x", vector_to_array("_v"))
    return joined.mapInArrow(residuals, "id long, residuo double")
