"""Benchmark decontamination by winnowing.

Of every WINDOW k-grams in a row the least hash is kept, in benchmark and documents alike. Two
texts that share k + WINDOW - 1 words in a row therefore share a kept hash. Documents meet the
benchmark's kept hashes in a join, and each hit is extended along its diagonal to the whole
shared span, which counts when it has SPAN words. So every shared span of that length is found.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rastro.llm.common import ALPHANUMERIC, ROW, Words, grams, numbered, slices, text_bytes, tidy, without

#: Words of a shared span; k-grams of K words in windows of WINDOW of them guarantee it.
SPAN, K = 13, 6
WINDOW = SPAN - K + 1

#: Bytes of benchmark text in one block; a block's index is sent to every task.
BLOCK_BYTES = 32_000_000

HITS = (
    "row long, doc_id long, n_words long, "
    "spans array<struct<start: int, end: int, item_id: string, first_byte: long, last_byte: long>>"
)


def winnowed(hashes: np.ndarray, window: int) -> np.ndarray:
    """Places of the hashes that are least in some window, ties included."""
    n = len(hashes)
    if n <= window:
        return np.flatnonzero(hashes == hashes.min()) if n else np.zeros(0, np.int64)
    least = hashes[: n - window + 1].copy()
    for j in range(1, window):
        np.minimum(least, hashes[j : n - window + 1 + j], out=least)
    # A hash is kept if it equals the greatest least of the windows around it.
    around = np.zeros(n, np.uint64)
    for j in range(window):
        np.maximum(around[j : j + len(least)], least, out=around[j : j + len(least)])
    return np.flatnonzero(hashes == around)


class Index:
    """Kept hashes of a block of benchmark items, and the items' words."""

    def __init__(self, item_ids: list[str], texts: pa.Array) -> None:
        words = Words(*text_bytes(texts), ALPHANUMERIC)
        self.item_ids, self.words, self.of = item_ids, words.hash, words.of
        long_items: list[tuple[np.ndarray, np.ndarray]] = []
        short: dict[int, list[tuple[np.uint64, int]]] = {}
        for i in range(len(item_ids)):
            low, high = words.of[i], words.of[i + 1]
            if high - low >= SPAN:
                hashes = grams(words.hash[low:high], K)
                kept = winnowed(hashes, WINDOW)
                long_items.append((hashes[kept], np.stack([np.full(len(kept), i), kept + low], 1)))
            elif high > low:
                m = int(high - low)
                short.setdefault(m, []).append((grams(words.hash[low:high], m)[0], i))
        self.long = self._sorted(long_items)
        self.short = {
            m: self._sorted([(np.array([h]), np.array([[i, words.of[i]]])) for h, i in items])
            for m, items in short.items()
        }

    @staticmethod
    def _sorted(parts):
        if not parts:
            return np.zeros(0, np.uint64), np.zeros((0, 2), np.int64)
        hashes = np.concatenate([h for h, _ in parts])
        order = np.argsort(hashes, kind="stable")
        return hashes[order], np.concatenate([p for _, p in parts])[order]

    def spans(self, words: Words) -> list[list[tuple[int, int, int]]]:
        """For each text the spans (first word, end, item) that it shares with items."""
        found: list[list[tuple[int, int, int]]] = [[] for _ in range(len(words.of) - 1)]
        if len(self.long[0]):
            hashes = grams(words.hash, K)
            # Windows over the border of two texts only keep more hashes.
            kept = winnowed(hashes, WINDOW)
            for text, at, item, place in self._met(words, hashes[kept], kept, *self.long, K):
                self._extend(words, text, item, at - place, found[text])
        for m, index in self.short.items():
            for text, at, item, _ in self._met(words, grams(words.hash, m), None, *index, m, same=False):
                first = at - int(words.of[text])
                found[text].append((first, first + m, item))
        return found

    def _met(self, words, hashes, places, known, entries, k, same=True):
        """Hits (text, word, item, item's word); of a diagonal only the first, if ``same``."""
        low = np.searchsorted(known, hashes, "left")
        hit = np.flatnonzero(known[np.minimum(low, len(known) - 1)] == hashes)
        if not len(hit):
            return
        at = places[hit] if places is not None else hit
        text = np.searchsorted(words.of, at, "right") - 1
        inside = at + k <= words.of[text + 1]
        at, text, low = at[inside], text[inside], low[hit][inside]
        counts = np.searchsorted(known, hashes[hit][inside], "right") - low
        which = np.repeat(np.arange(len(at)), counts)
        nth = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
        pairs = entries[low[which] + nth]
        table = np.stack([text[which], at[which], pairs[:, 0], pairs[:, 1]], 1)
        if same:
            _, first = np.unique(
                np.stack([table[:, 0], table[:, 2], table[:, 1] - table[:, 3]], 1), axis=0, return_index=True
            )
            table = table[first]
        yield from map(tuple, table.tolist())

    def _extend(self, words, text, item, shift, spans) -> None:
        """All shared spans of a text and an item on one diagonal."""
        low = max(int(self.of[item]), int(words.of[text]) - shift)
        high = min(int(self.of[item + 1]), int(words.of[text + 1]) - shift)
        equal = np.zeros(high - low + 2, dtype=np.int8)
        equal[1:-1] = self.words[low:high] == words.hash[low + shift : high + shift]
        change = np.diff(equal)
        begin = low + shift - int(words.of[text])
        for first, end in zip(np.flatnonzero(change == 1).tolist(), np.flatnonzero(change == -1).tolist()):
            if end - first >= SPAN:
                spans.append((begin + first, begin + end, item))


def _blocks(benchmark: DataFrame):
    """Benchmark items in blocks of about BLOCK_BYTES, one after the other."""
    items = benchmark.filter(F.col("text").isNotNull()).select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"), "text"
    )
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    count = max(1, -(-size // BLOCK_BYTES))
    for block in range(count):
        mine = F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == block
        yield (items.filter(mine) if count > 1 else items).toArrow()


def shared_spans(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """row, doc_id, n_words and ``spans``: where each document shares words with an item.

    A span has its first word and the word behind its end, the item and the bytes it covers
    in the UTF-8 text. ``row`` tells rows with the same doc_id apart.
    """
    spark = docs.sparkSession
    parts = []
    for table in _blocks(benchmark):
        texts = table.column("text").combine_chunks()
        index = Index(table.column("item_id").to_pylist(), texts)
        parts.append(_meet(docs, spark.sparkContext.broadcast(index)))
    if len(parts) == 1:
        return parts[0]
    together = reduce(DataFrame.unionByName, parts)
    # ``row`` follows the scan's partitions, so it is the same in every block.
    return together.groupBy("row", "doc_id", "n_words").agg(
        F.flatten(F.collect_list("spans")).alias("spans")
    )


def _meet(docs: DataFrame, shared) -> DataFrame:
    def meet(batches):
        index = shared.value
        for batch in batches:
            data, places = text_bytes(batch.column(2))
            for low, high in slices(places):
                own = places[low : high + 1]
                words = Words(data[own[0] : own[-1]], own - own[0], ALPHANUMERIC)
                spans = [
                    [
                        {
                            "start": a,
                            "end": b,
                            "item_id": index.item_ids[item],
                            "first_byte": int(words.start[words.of[i] + a] - (own[i] - own[0])),
                            "last_byte": int(words.end[words.of[i] + b - 1] - (own[i] - own[0])),
                        }
                        for a, b, item in sorted(set(found))
                    ]
                    for i, found in enumerate(index.spans(words))
                ]
                kind = pa.list_(
                    pa.struct(
                        [
                            ("start", pa.int32()),
                            ("end", pa.int32()),
                            ("item_id", pa.string()),
                            ("first_byte", pa.int64()),
                            ("last_byte", pa.int64()),
                        ]
                    )
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(low, high - low),
                        batch.column(1).slice(low, high - low),
                        pa.array(np.diff(words.of), pa.int64()),
                        pa.array(spans, kind),
                    ],
                    names=["row", "doc_id", "n_words", "spans"],
                )

    numbered = docs.select(F.monotonically_increasing_id(), F.col("doc_id").cast("long"), "text")
    return numbered.mapInArrow(tidy(meet), HITS)


def covered(spans: Column) -> Column:
    """Words inside any of the spans."""
    start = F.struct(F.lit(0).cast("int").alias("upto"), F.lit(0).cast("long").alias("n"))

    def add(held, span):
        fresh = span["end"] - F.greatest(held["upto"], span["start"])
        return F.struct(
            F.greatest(held["upto"], span["end"]).alias("upto"),
            (held["n"] + F.greatest(fresh, F.lit(0))).alias("n"),
        )

    return F.aggregate(F.array_sort(spans), start, add, lambda held: held["n"])


def contamination(docs: DataFrame, benchmark: DataFrame, one_in: int = 20) -> DataFrame:
    """row, doc_id, n_words, spans, n_hit, items and contaminated for every document.

    A document is contaminated if words are hit and at least one in ``one_in`` words is. Items
    shorter than SPAN words are found by their whole sequence; items without words by nothing.

    Null and empty texts have no words and are clean. Repeated rows, and rows with a null
    doc_id, are judged one by one. Items with equal texts or ids are each found; equal ids count
    once, a null id is called ``null``. Without documents the result is empty; without items
    all are clean. Other columns are not read, whatever their names. Long texts are worked on
    one at a time.
    """
    hits = shared_spans(docs, benchmark)
    return hits.withColumns(
        {
            "n_hit": covered(F.col("spans")),
            "items": F.array_sort(F.array_distinct(F.col("spans.item_id"))),
        }
    ).withColumn("contaminated", (F.col("n_hit") > 0) & (one_in * F.col("n_hit") >= F.col("n_words")))


def decontaminated(docs: DataFrame, benchmark: DataFrame, one_in: int = 20) -> DataFrame:
    """The rows that are not contaminated, each judged by its own text, all their columns kept,
    whatever their names. Long texts are judged whole, equal rows alike; null texts stay."""
    rows, number = numbered(docs)
    found = contamination(rows.select(F.col(number).alias("doc_id"), "text"), benchmark, one_in)
    return without(rows, number, found.filter("contaminated").select(F.col("doc_id").alias(ROW)))
