"""Jaccard join of word n-gram sets by prefixes under several global orders.

If two sets reach the similarity, they share a token among the first of each under any global
order of tokens. Orders here put tokens that many texts hold last, by a sketch of all counts,
and differ in how they order the rest. Under the first order, tokens are joined and a position
and a size bound prune; what is left must share prefix tokens under the other orders as well,
and only then are whole sets compared.

Links are needed only until everything they connect is connected. So a bucket of texts with one
token is not expanded into pairs: first all are held against one central text, then against one
of the largest component, and only texts that are still apart are paired.

All links of a text lie in its component. To count them, the sets of each component meet block
against block, blocks having sets of about one size, and a block sends on sums and no pairs.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rastro.llm.common import (
    BROADCAST_KEYS,
    NOT_SPACE,
    ROW,
    Words,
    grams,
    mixed,
    numbered,
    pinned,
    slices,
    text_bytes,
    tidy,
    with_keys,
    without,
)
from rastro.llm.components import components

#: Words of a shingle, and the similarity in percent.
N, PERCENT = 5, 80
#: Counters of the sketch; its size does not depend on the corpus.
SKETCH_BITS, CHUNK = 22, 1 << 16
#: Bits of a set's parity: token by token, one bit changes.
PARITY_BITS = 2048
#: Above the sketch's noise, a token in more texts than this counts as frequent.
FREQUENT = 8
#: What tells the orders apart: multipliers of the token's hash.
ORDERS = (1, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)

SETS = "doc_id long, n long, digest binary, centre int, parity array<long>, prefix array<long>"
#: Texts of either side of a cell, and pairs that small cells are put together to: sets meet
#: in cells, and a set is sent to a cell once.
CELL_SETS, CELL_PAIRS = 1024, 2048
#: Sets of a block whose links are counted, and tokens of them together; tokens that are laid
#: out side by side at a time.
BLOCK_SETS, BLOCK_TOKENS, SIDE_BY_SIDE = 256, 1 << 20, 4096


def token_sets(data: np.ndarray, places: np.ndarray, n: int = N):
    """The sorted distinct shingle hashes of each text."""
    words = Words(data, places, NOT_SPACE)
    hashes = grams(words.hash, n)
    for low, high in zip(words.of[:-1].tolist(), words.of[1:].tolist()):
        if high - low >= n:
            yield np.unique(hashes[low : high - n + 1])
        else:
            yield grams(words.hash[low:high], high - low) if high > low else hashes[:0]


def _sets(batches, text: int, n: int):
    for batch in batches:
        data, places = text_bytes(batch.column(text))
        for low, high in slices(places):
            own = places[low : high + 1]
            yield batch, low, high, list(token_sets(data[own[0] : own[-1]], own - own[0], n))


def _bucket(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def sketch(docs: DataFrame, n: int) -> np.ndarray:
    """How many texts hold tokens of each bucket, over all texts.

    Each task sends its counters once, compressed; they are added up as they come.
    """
    names = ["chunk", "values"]

    def count(batches):
        total = np.zeros(1 << SKETCH_BITS, np.uint32)
        for _, _, _, sets in _sets(batches, 0, n):
            np.add.at(total, _bucket(np.concatenate(sets)), np.uint32(1))
        rows = [zstandard.compress(row.tobytes(), 1) for row in total.reshape(-1, CHUNK)]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(rows)), pa.int32()), pa.array(rows)], names=names)

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, values in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = np.frombuffer(zstandard.decompress(values), np.uint32).astype(np.uint64)
                sums[chunk] = sums[chunk] + own if chunk in sums else own
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())],
            names=names,
        )

    schema, chunks = "chunk int, values binary", (1 << SKETCH_BITS) // CHUNK
    parts = docs.select("text").mapInArrow(tidy(count), schema).repartition(chunks, "chunk")
    total = np.zeros((chunks, CHUNK))
    for row in parts.mapInArrow(tidy(add), schema).toLocalIterator():
        total[row["chunk"]] = np.frombuffer(row["values"], np.uint64)
    return total.ravel()


def levels(counts: np.ndarray) -> np.ndarray:
    """How frequent the tokens of each bucket are; 0 is rare or too little to tell."""
    noise = counts.mean()
    above = counts - noise - 4 * np.sqrt(noise)
    return np.where(above <= FREQUENT, 0, np.floor(2 * np.log2(np.maximum(above, 1)))).astype(np.uint8)


def prefix(tokens: np.ndarray, level: np.ndarray, order: int, percent: int = PERCENT) -> np.ndarray:
    """The tokens of which a set as similar must hold one, in the order."""
    size = len(tokens) - -(-len(tokens) * percent // 100) + 1 if len(tokens) else 0
    ranked = tokens if order == 1 else mixed(tokens * np.uint64(order))
    return tokens[np.lexsort((ranked, level))[:size]]


def parity(tokens: np.ndarray) -> np.ndarray:
    """Bits of which two sets differ in no more than in tokens."""
    places = (tokens & np.uint64(PARITY_BITS - 1)).astype(np.int64)
    odd = (np.bincount(places, minlength=PARITY_BITS) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.uint64)


def _arrays(sets: list[np.ndarray]) -> pa.ListArray:
    places = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int32)
    values = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(places), pa.array(values))


def prefixes(docs: DataFrame, shared, n: int, percent: int) -> DataFrame:
    """Set size, digest of the set, centrality and first prefix of every text."""

    def rows(batches):
        known = shared.value
        for batch, low, high, sets in _sets(batches, 1, n):
            found = [known[_bucket(s)] for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(low, high - low),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s, digest_size=16).digest() for s in sets], pa.binary()),
                    pa.array([int(100 * f.mean()) if len(f) else 0 for f in found], pa.int32()),
                    _arrays([parity(s) for s in sets]),
                    _arrays([prefix(s, f, ORDERS[0], percent) for s, f in zip(sets, found)]),
                ],
                names=["doc_id", "n", "digest", "centre", "parity", "prefix"],
            )

    return docs.select("doc_id", "text").mapInArrow(tidy(rows), SETS)


def cell_sets(docs: DataFrame, n: int) -> DataFrame:
    """Whole sets of texts (doc_id, text, cell)."""

    def rows(batches):
        for batch, low, high, sets in _sets(batches, 1, n):
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(2).slice(low, high - low),
                    batch.column(0).slice(low, high - low),
                    pa.array([s.tobytes() for s in sets], pa.binary()),
                ],
                names=["cell", "v", "tokens"],
            )

    return docs.select("doc_id", "text", "cell").mapInArrow(tidy(rows), "cell long, v long, tokens binary")


def similar_pairs(pairs: pa.Table, sets: pa.Table, level: np.ndarray, percent: int) -> pa.Table:
    """The pairs of a cell that share prefix tokens under all orders and then are similar."""
    tokens = {
        v: np.frombuffer(t, np.uint64)
        for v, t in zip(sets.column("v").to_pylist(), sets.column("tokens").to_pylist())
    }
    others: dict[tuple[int, int], np.ndarray] = {}

    def first(v: int, order: int) -> np.ndarray:
        if (v, order) not in others:
            own = tokens[v]
            others[v, order] = np.sort(prefix(own, level[_bucket(own)], order, percent))
        return others[v, order]

    def common(a: np.ndarray, b: np.ndarray) -> int:
        if len(a) > len(b):
            a, b = b, a
        at = np.searchsorted(b, a)
        return int((b[np.minimum(at, len(b) - 1)] == a).sum())

    found = []
    for a, b in zip(pairs.column("a").to_pylist(), pairs.column("b").to_pylist()):
        x, y = tokens.get(a), tokens.get(b)
        if x is None or y is None:
            continue
        if all(common(first(a, o), first(b, o)) for o in ORDERS[1:]):
            if (100 + percent) * common(x, y) >= percent * (len(x) + len(y)):
                found.append((a, b))
    return pa.table(
        {c: pa.array([p[k] for p in found], pa.int64()) for k, c in enumerate(("a", "b"))}
    )


def common_tokens(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """How many tokens each set of ``a`` shares with each set of ``b``."""
    sets = [*a, *b]
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, which, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    # Tokens of one set alone are shared with none.
    place = np.where(times > 1, np.cumsum(times > 1) - 1, -1)[which]
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    total = np.zeros((len(a), len(b)), np.float64)
    for low in range(0, int(place[-1]) + 1, SIDE_BY_SIDE):
        first, last = np.searchsorted(place, (low, low + SIDE_BY_SIDE))
        there = np.zeros((len(sets), SIDE_BY_SIDE), np.float32)
        there[owner[first:last], place[first:last] - low] = 1
        total += there[: len(a)] @ there[len(a) :].T
    return total.astype(np.int64)


def counted_links(rows: pa.Table, percent: int) -> pa.Table:
    """(v, links): for each set of a cell, the documents of the sets that are similar to it.

    ``rows`` has (key, side, v, weight, tokens): under each key the sets of side 0 meet those of
    side 1, or those of side 2 each other.
    """
    blocks: dict[int, tuple[dict, dict, dict]] = {}
    columns = (rows.column(c).to_pylist() for c in ("key", "side", "v", "weight", "tokens"))
    for key, side, v, weight, tokens in zip(*columns):
        # Repeated rows of one document are one set.
        blocks.setdefault(key, ({}, {}, {}))[side][v] = (weight, np.frombuffer(tokens, np.uint64))
    found: dict[int, int] = {}
    for first, second, own in blocks.values():
        for x, y in ((first, second), (own, own)):
            if not x or not y:
                continue
            (wx, sx), (wy, sy) = zip(*x.values()), zip(*y.values())
            sizes = np.array([len(s) for s in sx])[:, None] + np.array([len(s) for s in sy])
            similar = (100 + percent) * common_tokens(sx, sy) >= percent * sizes
            if x is y:
                np.fill_diagonal(similar, False)
            for v, links in zip(x, (similar @ np.array(wy, np.int64)).tolist()):
                found[v] = found.get(v, 0) + links
            if x is not y:
                for v, links in zip(y, (np.array(wx, np.int64) @ similar).tolist()):
                    found[v] = found.get(v, 0) + links
    return pa.table(
        {"v": pa.array(list(found), pa.int64()), "links": pa.array(list(found.values()), pa.int64())}
    )


class NgramJoin:
    """One run over a table of documents; ``result`` is the table of components."""

    def __init__(self, docs: DataFrame, n: int = N, percent: int = PERCENT) -> None:
        self.spark = docs.sparkSession
        self.n, self.percent = n, percent
        self.docs = docs.select(F.col("doc_id").cast("long"), "text")
        level = levels(sketch(self.docs, n))
        self.level = self.spark.sparkContext.broadcast(level)
        self.table = pinned(prefixes(self.docs, self.level, n, percent))

    def copies(self) -> DataFrame:
        """(doc_id, v): documents whose set is that of the smaller document v."""
        there = self.table.filter("n > 0 AND doc_id IS NOT NULL").select("doc_id", "digest")
        classes = there.groupBy("digest").agg(F.min("doc_id").alias("v"), F.count(F.lit(1)).alias("c"))
        return there.join(classes.filter("c > 1").drop("c"), "digest").filter("doc_id <> v").select("doc_id", "v")

    def postings(self, copies: DataFrame, n_copies: int) -> DataFrame:
        """(token, v, n, pos, centre, before) for prefix tokens that two texts or more share;
        ``before`` is the one in front, of these."""
        keys = copies.select("doc_id").distinct()
        own = self.table.filter("n > 0 AND doc_id IS NOT NULL").join(
            F.broadcast(keys) if n_copies <= BROADCAST_KEYS else keys, "doc_id", "left_anti"
        )
        # Counted from the bare tokens, joined back to the full rows.
        counts = own.select(F.explode("prefix").alias("token")).groupBy("token").count().filter("count > 1")
        rows = own.select(
            F.posexplode("prefix").alias("pos", "token"), F.col("doc_id").alias("v"), "n", "centre"
        )
        shared = rows.join(counts.select("token"), "token")
        # No more rows than tokens in one text's prefix.
        order = Window.partitionBy("v").orderBy("pos")
        return shared.select(
            "token", "v", "n", "pos", "centre", F.lag("token").over(order).alias("before")
        )

    def may_link(self, x: str, y: str) -> Column:
        """Whether this token can be the first that two similar sets share: size and position
        bounds, and another shared token in front of it."""
        p = self.percent
        n, m, pos, at = (F.col(f"{t}.{c}") for c in ("n", "pos") for t in (x, y))
        return (
            (100 * F.least(n, m) >= p * F.greatest(n, m))
            & ((100 + p) * F.least(n - pos, m - at) >= p * (n + m))
            & ~F.coalesce(F.col(f"{x}.before") == F.col(f"{y}.before"), F.lit(False))
        )

    def by_parity(self, pairs: DataFrame) -> DataFrame:
        """Pairs whose sets differ in few enough bits of their parities, which differ in no
        more bits than the sets do in tokens."""
        p = self.percent
        own = self.table.filter("n > 0 AND doc_id IS NOT NULL").dropDuplicates(["doc_id"])
        for side in ("a", "b"):
            mine = own.select(
                F.col("doc_id").alias(side), F.col("n").alias(f"n_{side}"), F.col("parity").alias(f"p_{side}")
            )
            pairs = pairs.join(mine, side)
        bits = F.zip_with("p_a", "p_b", lambda x, y: F.bit_count(x.bitwiseXOR(y)))
        differing = F.aggregate(bits, F.lit(0), lambda total, x: total + x)
        kept = pairs.filter((100 + p) * differing <= (100 - p) * (F.col("n_a") + F.col("n_b")))
        return kept.select("a", "b", "near")

    def linked(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose sets are similar.

        Pairs that are ``near`` the same text or component meet in one cell, or in a grid of
        cells if they have very many texts, so that a set does not travel once for each pair.
        """
        pairs = pinned(self.by_parity(pairs))
        total = pairs.count()
        sides = pairs.groupBy("near").agg(
            F.ceil(F.approx_count_distinct("a") / CELL_SETS).alias("rows"),
            F.ceil(F.approx_count_distinct("b") / CELL_SETS).alias("columns"),
        )
        cell = F.xxhash64(
            "near", F.pmod(F.xxhash64("a"), F.col("rows")), F.pmod(F.xxhash64("b"), F.col("columns"))
        )
        celled = pinned(
            pairs.join(sides, "near").select(
                F.pmod(cell, F.lit(total // CELL_PAIRS + 1)).alias("cell"), "a", "b"
            )
        )
        members = pinned(
            celled.select("cell", F.col("a").alias("doc_id")).union(celled.select("cell", "b")).distinct()
        )
        small = members.count() <= BROADCAST_KEYS
        mine = self.docs.join(F.broadcast(members) if small else members, "doc_id")
        level, percent = self.level, self.percent

        def compare(pairs, sets):
            return similar_pairs(pairs, sets, level.value, percent)

        sets = cell_sets(mine, self.n)
        met = celled.groupBy("cell").cogroup(sets.groupBy("cell"))
        return pinned(met.applyInArrow(compare, "a long, b long"))

    def labelled(self, postings: DataFrame, links: DataFrame | None) -> DataFrame:
        """Postings with the component of their text and its size."""
        if links is None:
            return postings.withColumns({"component": F.col("v"), "size": F.lit(1).cast("long")})
        found = components(links)
        sizes = found.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
        known = pinned(found.join(sizes, "component"))
        small = known.count() <= BROADCAST_KEYS
        return (
            postings.join(F.broadcast(known) if small else known, "v", "left")
            .withColumns(
                {
                    "component": F.coalesce("component", "v"),
                    "size": F.coalesce("size", F.lit(1).cast("long")),
                }
            )
            .select(*postings.columns, "component", "size")
        )

    def against_one(self, rows: DataFrame) -> DataFrame:
        """Each text of a bucket with the bucket's central text: of the largest component the
        one with most frequent tokens."""
        pivots = rows.groupBy("token").agg(
            F.max(F.struct("size", "component", "centre", "v", "n", "pos", "before")).alias("p")
        ).select("token", "p.*")
        met = rows.alias("r").join(
            pivots.alias("p"),
            (F.col("r.token") == F.col("p.token"))
            & (F.col("r.component") != F.col("p.component"))
            & self.may_link("r", "p"),
        )
        return self.pairs(met, F.col("p.v"), F.col("r.v"), F.col("p.v"))

    @staticmethod
    def pairs(met: DataFrame, near: Column, x: Column, y: Column) -> DataFrame:
        """Each pair a < b once, and one of the texts or components that it was met near."""
        named = met.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b"), near.alias("near"))
        return named.groupBy("a", "b").agg(F.min("near").alias("near"))

    def still_apart(self, rows: DataFrame) -> DataFrame:
        """Pairs of texts of a bucket that are not in one component, the texts outside of the
        bucket's largest component against all."""
        main = rows.groupBy("token").agg(F.max(F.struct("size", "component")).alias("m"))
        main = main.select("token", F.col("m.component").alias("main"))
        others = rows.join(main, "token").filter("component <> main")
        apart = (F.col("r.component") != F.col("o.component")) & (
            (F.col("r.component") == F.col("o.main")) | (F.col("o.v") < F.col("r.v"))
        )
        joined = others.alias("o").join(
            rows.alias("r"), (F.col("o.token") == F.col("r.token")) & apart & self.may_link("o", "r")
        )
        return self.pairs(joined, F.col("o.main"), F.col("o.v"), F.col("r.v"))

    def connected(self) -> tuple[DataFrame, DataFrame]:
        """The documents that are copies (doc_id, v), and (v, component) of all sets with links."""
        copies = pinned(self.copies())
        postings = pinned(self.postings(copies, copies.count()))
        self.release()
        links, tried = None, None
        for step in (self.against_one, self.against_one, self.still_apart):
            pairs = step(self.labelled(postings, links))
            if tried is not None:
                pairs = pairs.join(tried, ["a", "b"], "left_anti")
            pairs = pinned(pairs)
            known = pairs.select("a", "b")
            tried = known if tried is None else tried.union(known)
            fresh = self.linked(pairs)
            links = fresh if links is None else links.union(fresh)
            self.release()
        return copies, components(links)

    def link_counts(self, found: DataFrame) -> DataFrame:
        """(doc_id, n_links) of the documents that link with others; ``found`` has the sets'
        components."""
        there = self.table.filter("n > 0 AND doc_id IS NOT NULL").select("doc_id", "digest", "n").distinct()
        classes = pinned(
            there.groupBy("digest", "n").agg(F.min("doc_id").alias("v"), F.count(F.lit(1)).alias("weight"))
        )
        # Similar sets are of one step of sizes or of two that follow each other.
        width = 1.001 * max(math.log(100 / self.percent), 0.01)
        members = pinned(
            found.join(classes, "v").withColumn("step", F.floor(F.log(F.col("n").cast("double")) / width))
        )
        blocks = F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK_SETS, F.sum("n") / BLOCK_TOKENS)).cast("long")
        sizes = pinned(members.groupBy("component", "step").agg(blocks.alias("blocks")))
        small = sizes.count() <= BROADCAST_KEYS
        for name, by in (("below", 1), ("above", -1)):
            beside = sizes.select("component", (F.col("step") + by).alias("step"), F.col("blocks").alias(name))
            members = members.join(F.broadcast(beside) if small else beside, ["component", "step"], "left")
        members = members.join(F.broadcast(sizes) if small else sizes, ["component", "step"])
        members = members.withColumn("block", F.pmod(F.xxhash64("v"), F.col("blocks")))
        step, block = F.col("step"), F.col("block")

        def cells(count: str, cell) -> Column:
            """A cell for each block of the step that has ``count`` of them."""
            numbers = F.sequence(F.lit(0).cast("long"), F.col(count) - 1)
            return F.when(F.col(count) > 0, F.transform(numbers, cell)).otherwise(F.array())

        def cell(side, *place) -> Column:
            return F.struct(side.alias("side"), F.xxhash64("component", *place).alias("key"))

        sides = [F.lit(x) for x in range(3)]
        own = cells(
            "blocks",
            lambda j: cell(
                F.when(block == j, sides[2]).when(block < j, sides[0]).otherwise(sides[1]),
                *(step, F.least(block, j), step, F.greatest(block, j)),
            ),
        )
        below = cells("below", lambda j: cell(sides[1], step - 1, j, step, block))
        above = cells("above", lambda j: cell(sides[0], step, block, step + 1, j))
        celled = pinned(
            members.select("v", "n", "weight", F.explode(F.concat(own, below, above)).alias("c")).select(
                "v", "n", "weight", "c.*"
            )
        )
        rows, tokens = celled.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        groups = max(rows // CELL_PAIRS, tokens // (2 * BLOCK_TOKENS)) + 1
        keys = members.select(F.col("v").alias("doc_id"))
        sets = cell_sets(
            with_keys(self.docs, keys, "doc_id", rows).withColumn("cell", F.lit(0).cast("long")), self.n
        )
        placed = celled.select("v", "weight", "side", "key", F.pmod("key", F.lit(groups)).alias("cell"))
        met = sets.drop("cell").join(F.broadcast(placed) if rows <= BROADCAST_KEYS else placed, "v")
        percent = self.percent
        sums = met.groupBy("cell").applyInArrow(lambda table: counted_links(table, percent), "v long, links long")
        linked = classes.join(sums.groupBy("v").agg(F.sum("links").alias("links")), "v", "left")
        # Copies of a set link with each other, too.
        links = F.coalesce("links", F.lit(0)) + F.col("weight") - 1
        counts = pinned(linked.select("digest", links.alias("n_links")).filter("n_links > 0"))
        small = counts.count() <= BROADCAST_KEYS
        return there.join(F.broadcast(counts) if small else counts, "digest").select("doc_id", "n_links")

    def result(self, counted: bool = False) -> DataFrame:
        copies, found = self.connected()
        if counted:
            found = pinned(found)
        out = self.members(copies, found)
        if not counted:
            return out
        links = pinned(self.link_counts(found))
        small = links.count() <= BROADCAST_KEYS
        return out.join(F.broadcast(links) if small else links, "doc_id", "left").select(
            *out.columns, F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links")
        )

    def members(self, copies: DataFrame, found: DataFrame) -> DataFrame:
        """Every document with its component."""
        of_copies = copies.join(found, "v", "left").select(
            "doc_id", F.coalesce("component", "v").alias("component_id")
        )
        known = pinned(
            of_copies.distinct().union(found.join(copies.select("doc_id").distinct(), found.v == F.col("doc_id"), "left_anti").select("v", "component"))
        )
        small = known.count() <= BROADCAST_KEYS
        rows = self.table.select("doc_id", F.col("n").alias("n_shingles"))
        return rows.join(F.broadcast(known) if small else known, "doc_id", "left").select(
            "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
        )

    def release(self) -> None:
        """Lets Spark's cleaner find the shuffle files of finished steps: they go when the
        driver collects its garbage, which otherwise may be long after the disk is full."""
        self.spark.sparkContext._jvm.System.gc()


def near_duplicates(docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id for every document.

    Two documents link when 100 * |intersection| >= percent * |union| of their sets of n-word
    shingles, words being what stands between ASCII white space, in lower case (A-Z). A text
    with fewer words has the one shingle of all its words. The component is the smallest doc_id
    that links reach. Links are found exactly, but of those inside a component that others
    connect already, not every one is looked at.

    Null and empty texts, and texts without words, have no shingles and link with nothing. Rows
    without an id are returned with their size and no component, and link with nothing. Copies
    link through the smallest of them. Rows with one doc_id are one document; they should not
    have different texts. An empty table gives an empty table. Columns other than doc_id and
    text are not read.
    """
    return NgramJoin(docs, n, percent).result()


def link_counts(docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """What near_duplicates returns, and n_links: the number of other documents that each one
    links with, copies among them.

    Every link counts, also inside a component that others connect already. Rows without an id
    have no links; repeated rows of one doc_id are one document and have its count each.
    """
    return NgramJoin(docs, n, percent).result(counted=True)


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each group of near copies, that with the smallest doc_id, all columns kept.

    Rows are compared one by one, also those with one doc_id or none; of equal ids one row stays.
    Texts without words link with none and stay; long texts are compared whole.
    """
    rows, number = numbered(docs)
    found = near_duplicates(rows.select(F.col(number).alias("doc_id"), "text"))
    # Rows that link with none are groups of their own.
    groups = found.groupBy("component_id").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    linked = found.join(groups.select("component_id"), "component_id")
    linked = linked.select(F.col("doc_id").alias(ROW), "component_id")
    members = pinned(linked.join(rows.select(F.col(number).alias(ROW), F.col("doc_id").cast("long").alias("doc_id")), ROW))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", ROW))
    stay = members.groupBy("component_id").agg(first.alias("first")).select(F.col(f"first.{ROW}").alias(ROW))
    return without(rows, number, members.join(stay, ROW, "left_anti"))
