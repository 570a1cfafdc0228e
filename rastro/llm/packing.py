"""Best-fit packing of tokenised documents into sequences of a fixed length.

Bulk-synchronous best fit. Documents are ranked within their length, so all documents of a
length are one run, and all sequences with the same gap are runs too. A superstep takes the
longest run still unplaced: a successor sweep over the gaps finds the smallest that holds the
length, ranks settle which documents get which of the sequences with that gap, the gaps are
updated, and the sweep goes on until the run is placed or no gap is left, when sequences are
opened for the rest. Lengths and gaps are whole numbers up to the sequence length, so a sweep
touches a bounded number of runs whatever the corpus; documents themselves are only ranked,
joined to their run's places and never gathered.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rastro.llm.common import held, pinned, tidy
from rastro.llm.pretokens import Cache, pieces, words_of

CAPACITY = 2048
END_ID = 0
#: Words whose ids a worker holds, in each of two generations.
CACHED_WORDS = 100_000
# The letters that stand for bytes in byte-level vocabularies. Visible characters
# stand for themselves, the other bytes for those from U+0100 on.
_VISIBLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
LETTERS = {b: chr(0x100 + k) for k, b in enumerate(b for b in range(0x100) if b not in _VISIBLE)}

PIECES = (
    "doc_id long, row long, piece int, start long, length long, ids_crc32 long, part long, nth long"
)
PLACES = pa.schema([(c, pa.int64()) for c in ("length", "low", "high", "each", "sequence", "offset")])


class Encoder:
    """Token ids of whole texts, as little-endian 32-bit numbers in a row.

    Words of the vocabulary's own pattern are encoded by the model of the ``tokenizers`` library,
    each once while it stays in the worker's cache, and joined; special strings inside texts are
    its special tokens. The model takes a word's bytes as letters: going straight to it saves
    splitting every new word once more.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        special = {
            t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special
        }
        self.special = {s: i.to_bytes(4, "little") for s, i in special.items()}
        self.split = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self.model = self.tokenizer.model
        self.words = Cache(self._word, size=CACHED_WORDS)

    def _word(self, word: str) -> bytes:
        if word.isascii() and word.isprintable():
            letters = word.replace(" ", LETTERS[0x20])
        else:
            letters = word.encode().decode("latin-1").translate(LETTERS)
        return b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(letters)])

    def ids(self, text: str) -> bytes:
        if not self.split or not any(s in text for s in self.special):
            return self._plain(text)
        return b"".join(
            self.special[part] if part in self.special else self._plain(part)
            for part in self.split.split(text)
        )

    def _plain(self, text: str) -> bytes:
        return b"".join([b"".join(map(self.words.__getitem__, words_of(p))) for p in pieces(text)])


def _encoder(path: str) -> Encoder:
    return held(("encoder", path), lambda: Encoder(path))


def cut(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """The pieces of every document: its ids and ``end_id``, cut from the end on into pieces of
    ``capacity`` tokens, so that only the first may be shorter.

    ``part`` and ``nth`` number the pieces of a length within a task. ``row`` tells rows with
    the same doc_id apart.
    """
    end = end_id.to_bytes(4, "little")

    def cut_rows(batches):
        encoder, part = _encoder(vocabulary), TaskContext.get().partitionId()
        met: dict[int, int] = {}
        row = part << 33
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = encoder.ids(text.as_py() or "") + end
                n, low, piece = len(data) // 4, 0, 0
                while low < n:
                    length = (n - low - 1) % capacity + 1 if low == 0 else capacity
                    crc = zlib.crc32(memoryview(data)[4 * low : 4 * (low + length)])
                    nth = met[length] = met.get(length, -1) + 1
                    out.append((doc_id, row, piece, low, length, crc, part, nth))
                    low, piece = low + length, piece + 1
                row += 1
            if out:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(values, pa.int32() if i == 2 else pa.int64())
                        for i, values in enumerate(zip(*out))
                    ],
                    names=[f.split()[0] for f in PIECES.split(", ")],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(tidy(cut_rows, holds=True), PIECES)


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Places for runs of equal lengths, from their sizes.

    A place (length, low, high, each, sequence, offset) says that the documents of this length
    with ranks from ``low`` up to ``high`` go into the sequences from ``sequence`` on, ``each``
    in a row into one, the first at ``offset``. At most ``capacity`` lengths and as many gaps
    exist, so the list is bounded for any number of documents.
    """
    places: list[tuple[int, int, int, int, int, int]] = []
    gaps: list[int] = []  # sorted; the gaps for which there are sequences
    runs: dict[int, list[tuple[int, int]]] = {}  # gap -> runs of sequences [low, high)
    opened = 0

    def put(gap: int, low: int, high: int) -> None:
        if gap > 0 and low < high:
            if gap not in runs:
                insort(gaps, gap)
                runs[gap] = []
            runs[gap].append((low, high))

    for length in sorted(counts, reverse=True):
        low, high = 0, counts[length]
        while low < high:
            at = bisect_left(gaps, length)
            if at < len(gaps):
                gap = gaps[at]
                first, last = runs[gap].pop()
                if not runs[gap]:
                    del runs[gap], gaps[at]
            else:
                gap, first = capacity, opened
                last = opened = opened + -(-(high - low) // (capacity // length))
            each = gap // length
            taken = min(high - low, each * (last - first))
            full, rest = divmod(taken, each)
            places.append((length, low, low + taken, each, first, capacity - gap))
            put(gap - each * length, first, first + full)
            if rest:
                put(gap - rest * length, first + full, first + full + 1)
            put(gap, first + full + (rest > 0), last)
            low += taken
    return places


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row for each piece of each document, with its sequence and its place there.

    Returns doc_id, row, piece, start, length, ids_crc32, sequence_id, offset. Pieces of a
    sequence follow one another without gaps from offset 0 and fill at most ``capacity``
    tokens. Longer documents come first; each piece goes where it leaves the smallest gap.

    A null text is an empty one and has the one token ``end_id``; so every row has a piece.
    Repeated rows, and rows with a null doc_id, are documents of their own, told apart by
    ``row``. Ties between pieces of one length fall by task and place in the task. An empty
    table gives an empty table. Other columns are not read, whatever their names.
    """
    spark = docs.sparkSession
    # Written, so that a task that runs again finds the same ranks.
    table = pinned(cut(docs, vocabulary, capacity, end_id))
    by_part = table.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    # One row for each length and task, however many documents share the length.
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pinned(by_part.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0))))
    # At most ``capacity`` rows.
    sizes = offsets.groupBy("length").agg(F.sum("n").alias("n")).collect()
    found = best_fit({r["length"]: r["n"] for r in sizes}, capacity)
    # As a table of Arrow: a list of rows would start Python workers of its own in every executor.
    places = spark.createDataFrame(
        pa.Table.from_arrays([pa.array([p[i] for p in found], pa.int64()) for i in range(len(PLACES))], schema=PLACES)
    )
    ranked = table.join(offsets.drop("n"), ["length", "part"]).withColumn(
        "rank", F.col("first") + F.col("nth")
    )
    placed = ranked.join(
        F.broadcast(places.withColumnRenamed("length", "of")),
        (F.col("length") == F.col("of")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")),
    )
    within = F.col("rank") - F.col("low")
    return placed.select(
        "doc_id",
        "row",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("sequence") + F.floor(within / F.col("each"))).alias("sequence_id"),
        (F.col("offset") + within % F.col("each") * F.col("length")).alias("offset"),
    )
