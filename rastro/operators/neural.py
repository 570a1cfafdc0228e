"""A ranker with learned embeddings: matrix factorisation and a perceptron side by side.

Each user and item has two vectors. The product of the first ones (the factorisation path) and
the top layer of a perceptron over the second ones (the deep path) give the probability of an
interaction. Vectors and network are learned together, with log-loss and Adam, from positives
and negatives that every epoch draws anew.

Users and items lie in blocks, and an epoch has as many rounds as there are item blocks. In a
round each user block meets one item block, in one task, with the positives of that cell: so a
user's vector is changed by one task at a time, and inside a task gradients are summed by id,
batch by batch. If there are more user blocks than item blocks, several tasks change one item
block; its rows are then averaged by how often each task touched them. The network is small and
goes to every task; its copies are averaged by the examples they saw. After every round the
blocks are written to the shared folder, so a lost executor costs tasks of one round.

Negatives of a user need no join: all items of a block that the user has seen are positives of
the cell. A user gets its share of negatives from each block, by the size of the block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rastro.session import new_folder, pinned, remove_folder

# Sizes of the vectors and of the hidden layers, as the reports give them.
FACTOR_SIZE, DEEP_SIZE = 32, 32
HIDDEN_LAYERS = (64, 32, 16)
#: Deviation of the first vectors.
FIRST_DEVIATION = 0.01
#: Rows of a block; a task holds a user block and an item block with their moments.
BLOCK_ROWS = 50_000
LEAST_BLOCKS = 8
#: Copies of the network that are added up by one task before they reach the driver.
COPIES = 64
#: A negative that was seen is drawn again so many times.
TRIES = 10
DECAY, DECAY_SQUARES, TINY = 0.9, 0.999, 1e-8

STATE = "side string, block int, data binary, n long, loss double"


@dataclass(frozen=True)
class Shape:
    """Sizes of the network; its numbers are kept as one array."""

    factor: int = FACTOR_SIZE
    deep: int = DEEP_SIZE
    hidden: tuple[int, ...] = HIDDEN_LAYERS

    @property
    def width(self) -> int:
        return self.factor + self.deep

    def layers(self) -> list[tuple[int, int]]:
        sizes = [2 * self.deep, *self.hidden]
        return list(zip(sizes, sizes[1:]))

    def size(self) -> int:
        return sum(a * b + b for a, b in self.layers()) + self.factor + self.hidden[-1] + 1

    def first(self, seed: int) -> np.ndarray:
        draw, parts = np.random.default_rng(seed), []
        for a, b in [*self.layers(), (self.factor + self.hidden[-1], 1)]:
            parts.append(draw.uniform(-1 / sqrt(a), 1 / sqrt(a), a * b + b))
        return np.concatenate(parts).astype(np.float32)

    def unpack(self, flat: np.ndarray):
        """Views of the weights and offsets of each layer, and of the last one."""
        at, layers = 0, []
        for a, b in self.layers():
            layers.append((flat[at : at + a * b].reshape(a, b), flat[at + a * b : at + a * b + b]))
            at += a * b + b
        return layers, flat[at:-1], flat[-1:]


def forward(shape: Shape, flat: np.ndarray, users: np.ndarray, items: np.ndarray):
    """Log-odds of pairs, and what the way back needs."""
    layers, last, offset = shape.unpack(flat)
    f = shape.factor
    product = users[:, :f] * items[:, :f]
    values = [np.concatenate([users[:, f:], items[:, f:]], axis=1)]
    for weights, shift in layers:
        values.append(np.maximum(values[-1] @ weights + shift, 0))
    return product @ last[:f] + values[-1] @ last[f:] + offset, product, values


def gradients(shape: Shape, flat, users, items, labels):
    """(summed log-loss, gradient of the mean loss by network, by user rows, by item rows)."""
    odds, product, values = forward(shape, flat, users, items)
    layers, last, _ = shape.unpack(flat)
    f, d, n = shape.factor, shape.deep, len(labels)
    loss = float(np.sum(np.logaddexp(0, odds) - labels * odds))
    delta = ((1 / (1 + np.exp(-np.clip(odds, -60, 60))) - labels) / n).astype(flat.dtype)
    out = np.empty_like(flat)
    into, into_last, into_offset = shape.unpack(out)
    into_last[:f], into_last[f:] = delta @ product, delta @ values[-1]
    into_offset[:] = delta.sum()
    back = delta[:, None] * last[None, f:]
    for k in reversed(range(len(layers))):
        back = back * (values[k + 1] > 0)
        into[k][0][:], into[k][1][:] = values[k].T @ back, back.sum(axis=0)
        back = back @ layers[k][0].T
    through = delta[:, None] * last[None, :f]
    by_user = np.concatenate([through * items[:, :f], back[:, :d]], axis=1)
    by_item = np.concatenate([through * users[:, :f], back[:, d:]], axis=1)
    return loss, out, by_user, by_item


class Block:
    """Vectors of some ids with the moments of their gradients and their numbers of steps."""

    def __init__(self, rows: np.ndarray, count: np.ndarray) -> None:
        self.rows, self.count = rows, count
        self.first, self.second = np.zeros_like(rows), np.zeros_like(rows)
        self.steps = np.zeros(len(rows), np.int32)
        #: Steps of the last round.
        self.touched = np.zeros(len(rows), np.int32)

    def __len__(self) -> int:
        return len(self.rows)

    def pack(self) -> bytes:
        parts = (self.rows, self.first, self.second, self.steps, self.touched, self.count)
        return len(self.rows).to_bytes(8, "little") + b"".join(p.tobytes() for p in parts)

    @staticmethod
    def unpack(data: bytes, width: int) -> Block:
        n, at = int.from_bytes(data[:8], "little"), 8
        block = Block.__new__(Block)
        for name in ("rows", "first", "second"):
            setattr(block, name, np.frombuffer(data, np.float32, n * width, at).reshape(n, width).copy())
            at += 4 * n * width
        for name in ("steps", "touched", "count"):
            setattr(block, name, np.frombuffer(data, np.int32, n, at).copy())
            at += 4 * n
        return block

    def step(self, ids: np.ndarray, by_pair: np.ndarray, rate: float) -> None:
        """Sums gradients by id and moves the rows of these ids."""
        order = np.argsort(ids, kind="stable")
        rows, starts = np.unique(ids[order], return_index=True)
        slope = np.add.reduceat(by_pair[order], starts, axis=0)
        self.steps[rows] += 1
        self.touched[rows] += 1
        first = self.first[rows] = DECAY * self.first[rows] + (1 - DECAY) * slope
        second = self.second[rows] = DECAY_SQUARES * self.second[rows] + (1 - DECAY_SQUARES) * slope**2
        t = self.steps[rows][:, None]
        size = np.sqrt(second / (1 - DECAY_SQUARES**t)) + TINY
        self.rows[rows] -= (rate * first / (1 - DECAY**t) / size).astype(np.float32)


def negatives_of(draw, count: np.ndarray, share: float, n: int, items: int, seen: np.ndarray):
    """(user rows, item rows) of a cell's negatives: each user's share of ``n`` for each of its
    positives, drawn evenly from the items of the block that it has not seen. ``seen`` has the
    sorted codes user · items + item of the cell's positives."""
    wanted = np.floor(n * share * count + draw.random(len(count))).astype(np.int64)
    users = np.repeat(np.arange(len(count)), wanted)
    if not items or not len(users):
        return users[:0], users[:0]
    found = draw.integers(0, items, len(users))
    for last in range(TRIES + 1):
        codes = users * items + found
        bad = np.flatnonzero(seen[np.minimum(np.searchsorted(seen, codes), len(seen) - 1)] == codes) if len(seen) else []
        if not len(bad):
            break
        if last == TRIES:
            keep = np.ones(len(users), bool)
            keep[bad] = False
            return users[keep], found[keep]
        found[bad] = draw.integers(0, items, len(bad))
    return users, found


def train_cell(shape, network, users: Block, items: Block, pairs, copies, draw, share, negatives, batch, rate):
    """One pass over a cell's positives and fresh negatives; (examples, summed loss).

    ``network`` has the numbers, both moments and the steps; it is changed in place, as are the
    blocks."""
    own, theirs = pairs
    seen = np.unique(own * max(1, len(items)) + theirs)
    u, i = negatives_of(draw, users.count, share, negatives, len(items), seen)
    labels = np.concatenate([np.ones(int(copies.sum()), np.float32), np.zeros(len(u), np.float32)])
    u = np.concatenate([np.repeat(own, copies), u])
    i = np.concatenate([np.repeat(theirs, copies), i])
    order, total = draw.permutation(len(u)), 0.0
    for low in range(0, len(order), batch):
        some = order[low : low + batch]
        loss, slope, by_user, by_item = gradients(shape, network[0], users.rows[u[some]], items.rows[i[some]], labels[some])
        total += loss
        users.step(u[some], by_user, rate)
        items.step(i[some], by_item, rate)
        network[3] += 1
        network[1] = DECAY * network[1] + (1 - DECAY) * slope
        network[2] = DECAY_SQUARES * network[2] + (1 - DECAY_SQUARES) * slope**2
        t = int(network[3])
        size = np.sqrt(network[2] / (1 - DECAY_SQUARES**t)) + TINY
        network[0] = network[0] - (rate * network[1] / (1 - DECAY**t) / size).astype(np.float32)
    return len(order), total


def _rows(found: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int32(), pa.binary(), pa.int64(), pa.float64()]
    columns = zip(*found) if found else [[]] * 5
    names = [f.split()[0] for f in STATE.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def averaged(copies: Iterator[Block]) -> Block | None:
    """One item block from its copies: rows by the steps they made in this round."""
    total = None
    for copy in copies:
        weight = copy.touched.astype(np.float32)[:, None]
        if total is None:
            total, before = copy, copy.steps - copy.touched
            idle = [copy.rows.copy(), copy.first.copy(), copy.second.copy()]
            sums, weights = [weight * part for part in idle], weight.copy()
            most = copy.touched.copy()
            continue
        for part, own in zip(sums, (copy.rows, copy.first, copy.second)):
            part += weight * own
        weights += weight
        most = np.maximum(most, copy.touched)
    if total is None:
        return None
    moved = weights[:, 0] > 0
    for name, part, still in zip(("rows", "first", "second"), sums, idle):
        setattr(total, name, np.where(moved[:, None], part / np.maximum(weights, 1), still).astype(np.float32))
    total.steps, total.touched = before + most, np.zeros_like(most)
    return total


@dataclass
class NeuralRanker:
    """Learned vectors as tables (id, features), the network, and the mean loss of each epoch."""

    shape: Shape
    network: np.ndarray
    users: DataFrame
    items: DataFrame
    losses: list[float] = field(default_factory=list)

    def score(self, pairs: DataFrame) -> DataFrame:
        """Add ``score``, the probability of an interaction, to rows with u_idx and i_idx. A
        pair whose user or item was not there to be learned gets no row."""
        shape, flat = self.shape, self.network
        left = self.users.select(F.col("id").alias("u_idx"), F.col("features").alias("_u"))
        right = self.items.select(F.col("id").alias("i_idx"), F.col("features").alias("_i"))
        joined = pairs.join(left, "u_idx").join(right, "i_idx").select(*pairs.columns, "_u", "_i")

        def scored(batches):
            for batch in batches:
                own, theirs = (
                    batch.column(at).flatten().to_numpy().reshape(-1, shape.width) for at in (-2, -1)
                )
                odds = forward(shape, flat, own, theirs)[0].astype(np.float64)
                kept = batch.select(batch.schema.names[:-2])
                yield kept.append_column("score", pa.array(1 / (1 + np.exp(-np.clip(odds, -60, 60)))))

        schema = pairs.select(*pairs.columns, F.lit(0.0).alias("score")).schema
        return joined.mapInArrow(scored, schema)


def _first_users(cells: DataFrame, blocks: int, n: int, shape: Shape, seed: int) -> DataFrame:
    def first(batches):
        block = TaskContext.get().partitionId()
        count = np.zeros(max(0, -(-(n - block) // blocks)), np.int32)
        for batch in batches:
            count[batch.column(1).to_numpy()] = batch.column(2).to_numpy()
        yield _rows([("u", block, _first_block(shape, count, seed, 0, block).pack(), 0, 0.0)])

    counts = cells.groupBy("u_idx").agg(F.sum("copies").alias("n"))
    placed = counts.select(
        F.pmod("u_idx", F.lit(blocks)).cast("int").alias("block"), F.floor(F.col("u_idx") / blocks).alias("row"), "n"
    )
    return placed.repartitionById(blocks, "block").mapInArrow(first, STATE)


def _first_items(spark, blocks: int, n: int, shape: Shape, seed: int) -> DataFrame:
    def first(batches):
        for batch in batches:
            for block in batch.column(0).to_pylist():
                count = np.zeros(max(0, -(-(n - block) // blocks)), np.int32)
                yield _rows([("i", block, _first_block(shape, count, seed, 1, block).pack(), 0, 0.0)])

    return spark.range(blocks).mapInArrow(first, STATE)


def _first_block(shape: Shape, count, seed: int, side: int, block: int) -> Block:
    draw = np.random.default_rng([seed, side, block])
    return Block(draw.normal(0, FIRST_DEVIATION, (len(count), shape.width)).astype(np.float32), count)


def fit_neural(
    positives: DataFrame,
    n_users: int,
    n_items: int,
    epochs: int = 10,
    negatives: int = 4,
    batch: int = 1024,
    rate: float = 0.001,
    seed: int = 42,
    shape: Shape | None = None,
    user_blocks: int | None = None,
    item_blocks: int | None = None,
) -> NeuralRanker:
    """Learn from rows (u_idx, i_idx), one for each positive event, indices from 0 without gaps.

    A pair that repeats counts each time. ``negatives`` items are drawn for each positive, anew
    in every epoch; a user who has seen nearly a whole block gets fewer from it. Blocks have
    ``BLOCK_ROWS`` ids at most. The same data, seed and numbers of blocks give the same model.
    """
    spark, shape = positives.sparkSession, shape or Shape()
    items_n = item_blocks or max(min(LEAST_BLOCKS, n_items), ceil(n_items / BLOCK_ROWS))
    users_n = user_blocks or max(items_n, ceil(n_users / BLOCK_ROWS))
    if users_n < items_n:
        raise ValueError("a round needs a user block for each item block")
    cells = pinned(positives.groupBy("u_idx", "i_idx").agg(F.count(F.lit(1)).alias("copies")))
    user, item = F.pmod("u_idx", F.lit(users_n)), F.pmod("i_idx", F.lit(items_n))
    path = new_folder(spark, "cells")
    cells.select(
        user.cast("int").alias("key"),
        F.pmod(item - user, F.lit(items_n)).cast("int").alias("round"),
        F.floor(F.col("u_idx") / users_n).cast("int").alias("u"),
        F.floor(F.col("i_idx") / items_n).cast("int").alias("i"),
        F.col("copies").cast("int").alias("copies"),
    ).repartition("round").write.partitionBy("round").parquet(path)
    placed = spark.read.parquet(path)

    first = _first_users(cells, users_n, n_users, shape, seed).unionByName(
        _first_items(spark, items_n, n_items, shape, seed)
    )
    state, folder = _written(first)
    flat = shape.first(seed)
    network = [flat, np.zeros_like(flat), np.zeros_like(flat), 0]
    losses = []
    for epoch in range(epochs):
        examples, total = 0, 0.0
        for number in range(items_n):
            args = (shape, network, items_n, users_n, n_items, negatives, batch, rate, [seed, epoch, number])
            done, fresh = _written(_round(state, placed, number, args))
            n, loss, network = _mean_network(done, network, users_n)
            examples, total = examples + n, total + loss
            remove_folder(spark, folder)
            state, folder = done.filter("side <> 'w'"), fresh
            if users_n > items_n:
                done, fresh = _written(_merged_items(state, shape, items_n))
                remove_folder(spark, folder)
                state, folder = done, fresh
        losses.append(total / max(1, examples))
    remove_folder(spark, path)
    vectors = {
        side: pinned(_vectors(state.filter(F.col("side") == side), shape, blocks))
        for side, blocks in (("u", users_n), ("i", items_n))
    }
    remove_folder(spark, folder)
    return NeuralRanker(shape, network[0], vectors["u"], vectors["i"], losses)


def _written(state: DataFrame) -> tuple[DataFrame, str]:
    """The rows by side, so that a read of the small copies passes by the blocks."""
    path = new_folder(state.sparkSession, "blocks")
    state.write.partitionBy("side").parquet(path)
    return state.sparkSession.read.schema(state.schema).parquet(path).select(*state.columns), path


def _round(state: DataFrame, placed: DataFrame, number: int, args) -> DataFrame:
    """All user blocks, each with its item block and cell of this round."""
    shape, network, items_n, users_n, n_items, negatives, batch, rate, seeds = args
    meets = F.pmod(F.col("block") - number, F.lit(items_n))
    nothing = [F.lit(None).cast("int").alias(c) for c in ("u", "i", "copies")]
    users = state.filter("side = 'u'").select(F.col("block").alias("key"), "side", "block", "data", *nothing)
    items = state.filter("side = 'i'").select(
        F.explode(F.sequence(meets.cast("int"), F.lit(users_n - 1), F.lit(items_n))).alias("key"),
        "side", "block", "data", *nothing,
    )
    pairs = placed.filter(F.col("round") == number).select(
        "key", F.lit("p").alias("side"), F.lit(None).cast("int").alias("block"),
        F.lit(None).cast("binary").alias("data"), "u", "i", "copies",
    )

    def visit(batches):
        blocks, parts = {}, []
        for rows in batches:
            sides = rows.column(1)
            mine = rows.filter(pc.equal(sides, "p"))
            if mine.num_rows:
                parts.append([mine.column(c).to_numpy().astype(np.int64) for c in (4, 5, 6)])
            for at in np.flatnonzero(pc.not_equal(sides, "p").to_numpy(zero_copy_only=False)).tolist():
                block = Block.unpack(rows.column(3)[at].as_py(), shape.width)
                blocks[sides[at].as_py()] = (rows.column(2)[at].as_py(), block)
        (u_at, users), (i_at, items) = blocks["u"], blocks["i"]
        users.touched[:], items.touched[:] = 0, 0
        u, i, copies = (np.concatenate(c) for c in zip(*parts)) if parts else (np.zeros(0, np.int64),) * 3
        order = np.lexsort((i, u))
        own = [*network]
        draw = np.random.default_rng([*seeds, u_at, i_at])
        share = len(items) / max(1, n_items)
        n, loss = train_cell(
            shape, own, users, items, (u[order], i[order]), copies[order], draw, share, negatives, batch, rate
        )
        sent = np.concatenate([*own[:3], [own[3]]]).astype(np.float64) * n
        yield _rows([("u", u_at, users.pack(), n, loss)])
        yield _rows([("i", i_at, items.pack(), 0, 0.0), ("w", u_at, sent.tobytes(), n, loss)])

    together = users.unionByName(items).unionByName(pairs)
    return together.repartitionById(users_n, "key").mapInArrow(visit, STATE)


def _mean_network(done: DataFrame, before, users_n: int):
    """Examples, summed loss and the mean network, weighted by examples."""

    def add(batches):
        sums, n, loss = 0, 0, 0.0
        for rows in batches:
            for data, k, part in zip(rows.column(2), *(rows.column(c).to_pylist() for c in (3, 4))):
                sums, n, loss = sums + np.frombuffer(data.as_py(), np.float64), n + k, loss + part
        if n:
            yield _rows([("w", 0, sums.tobytes(), n, loss)])

    copies = done.filter("side = 'w'")
    if users_n > COPIES:
        copies = copies.repartition(users_n // COPIES)
    found = copies.mapInArrow(add, STATE).collect()
    n = sum(r["n"] for r in found)
    if not n:
        return 0, 0.0, before
    mean = sum(np.frombuffer(r["data"], np.float64) for r in sorted(found, key=lambda r: r["loss"])) / n
    size = len(before[0])
    parts = [mean[k * size : (k + 1) * size].astype(np.float32) for k in range(3)]
    return n, sum(r["loss"] for r in found), [*parts, int(round(mean[-1]))]


def _merged_items(state: DataFrame, shape: Shape, items_n: int) -> DataFrame:
    def merge(batches):
        block = TaskContext.get().partitionId()
        copies = (Block.unpack(data.as_py(), shape.width) for rows in batches for data in rows.column(2))
        found = averaged(copies)
        if found is not None:
            yield _rows([("i", block, found.pack(), 0, 0.0)])

    items = state.filter("side = 'i'").repartitionById(items_n, "block").mapInArrow(merge, STATE)
    return state.filter("side = 'u'").unionByName(items)


def _vectors(state: DataFrame, shape: Shape, blocks: int) -> DataFrame:
    def spread(batches):
        for rows in batches:
            for block, data in zip(rows.column(1).to_pylist(), rows.column(2)):
                vectors = Block.unpack(data.as_py(), shape.width).rows
                for low in range(0, len(vectors), 10_000):
                    some = vectors[low : low + 10_000]
                    ids = block + blocks * np.arange(low, low + len(some), dtype=np.int64)
                    places = pa.array(np.arange(0, some.size + 1, shape.width, dtype=np.int32))
                    lists = pa.ListArray.from_arrays(places, pa.array(some.ravel()))
                    yield pa.RecordBatch.from_arrays([pa.array(ids), lists], names=["id", "features"])

    return state.mapInArrow(spread, "id long, features array<float>")
