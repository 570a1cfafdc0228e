"""Helpers of the operators below: written tables, checked broadcasts, words as hashes."""

from __future__ import annotations

import ctypes
import gc
import hashlib
import os
from collections.abc import Callable, Hashable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rastro.session import pinned

#: Keys of eight bytes that a broadcast may hold; larger sets go through a shuffle.
BROADCAST_KEYS = 1_000_000

#: Rows that travel to a Python worker at a time: texts are long, and both sides hold a batch.
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
TEXTS_PER_BATCH = 1000

#: The column of row numbers; longer where a table has one of that name.
ROW = "_row_number"

#: Longer words are hashed by their bytes: sums of powers modulo 2^64 can agree by the pattern of
#: two words, whatever the base, from 1,024 bytes on.
LONG_WORD = 64

#: Texts are worked on in slices of about so many bytes: arrays over them have eight for each.
SLICE = 1 << 18

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """A table with True for each byte in one of the closed ranges."""
    table = np.zeros(256, dtype=bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


#: [^\x20\x09-\x0D] and [^\x00-\x2F\x3A-\x60\x7B-\x7F] over lower-cased UTF-8 bytes.
NOT_SPACE = ~byte_class((0x20, 0x20), (0x09, 0x0D))
ALPHANUMERIC = byte_class((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POWERS: list[np.ndarray] = []


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads close values (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_HELD: dict[Hashable, object] = {}


def held(name: Hashable, make: Callable):
    """What ``make`` gives, once for a worker while its tasks ask for this name alone.

    A worker outlives a stage. When a task asks for another name, what the stage before has left
    here goes first, and its memory returns to the system.
    """
    if name not in _HELD:
        _let_go()
        _HELD[name] = make()
    return _HELD[name]


def _let_go() -> None:
    _HELD.clear()
    _POWERS.clear()
    gc.collect()
    _returned()


def _returned() -> None:
    """Memory that is free inside the process returns to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library keeps it for later use
        pass


def tidy(work: Callable, holds: bool = False) -> Callable:
    """``work`` over the batches of a task, without what other stages have left in the worker
    (unless it ``holds`` something itself), and giving back at its end what it has freed."""

    # What is sent to workers has no state of this module in it, only the name of a function.
    def tidied(batches):
        yield from _tidied(work, holds, batches)

    return tidied


def _tidied(work: Callable, holds: bool, batches: Iterator) -> Iterator:
    if _HELD and not holds:
        _let_go()
    try:
        yield from work(batches)
    finally:
        _returned()


def _powers(n: int) -> list[np.ndarray]:
    if not _POWERS or len(_POWERS[0]) <= n:
        size = max(n + 1, SLICE + 64)
        _POWERS[:] = [
            np.cumprod(np.concatenate(([np.uint64(1)], np.full(size, step, np.uint64))))
            for step in (_BASE, _INVERSE)
        ]
    return _POWERS


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column and the places where its rows begin and end; null is empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    places = np.frombuffer(column.buffers()[1], np.int64)[column.offset :][: len(column) + 1]
    if len(places) == 0 or column.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[places[0] : places[-1]]
    return data, places - places[0]


class Words:
    """The words of a run of texts: hash, first byte and end of each, and where each text begins."""

    def __init__(self, data: np.ndarray, places: np.ndarray, table: np.ndarray) -> None:
        hashes, starts, ends = [], [], []
        low, n = 0, len(data)
        borders = np.zeros(n + 1, dtype=bool)
        borders[places] = True
        while low < n:
            high = min(low + SLICE, n)
            while high < n and not borders[high] and table[_LOWER[data[high]]]:
                high += 1  # a word is not cut
            piece = _LOWER[data[low:high]]
            inside = table[piece]
            before = np.concatenate(([False], inside[:-1])) & ~borders[low:high]
            after = np.concatenate((inside[1:], [False])) & ~borders[low + 1 : high + 1]
            first = np.flatnonzero(inside & ~before)
            last = np.flatnonzero(inside & ~after) + 1
            up, down = _powers(high - low)
            sums = np.zeros(high - low + 1, np.uint64)
            np.cumsum((piece.astype(np.uint64) + np.uint64(1)) * up[: high - low], out=sums[1:])
            own = mixed((sums[last] - sums[first]) * down[first])
            for i in np.flatnonzero(last - first > LONG_WORD).tolist():
                digest = hashlib.blake2b(piece[first[i] : last[i]], digest_size=8).digest()
                own[i] = int.from_bytes(digest, "little")
            hashes.append(own)
            starts.append(first + low)
            ends.append(last + low)
            low = high
        empty = np.zeros(0, np.int64)
        self.hash = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        self.start = np.concatenate(starts) if starts else empty
        self.end = np.concatenate(ends) if ends else empty
        #: Text i has the words from of[i] to of[i + 1].
        self.of = np.searchsorted(self.start, places)


def grams(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of every k words in a row."""
    if len(words) < k:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(words) - k + 1, np.uint64)
    for j in range(k):
        total = total * _BASE + words[j : len(words) - k + 1 + j]
    return mixed(total + np.uint64(k))


def slices(places: np.ndarray, most: int = SLICE, rows: int | None = None) -> Iterator[tuple[int, int]]:
    """Runs of at most ``rows`` rows with about ``most`` bytes; a longer row stands alone."""
    low, n = 0, len(places) - 1
    while low < n:
        high = max(low + 1, int(np.searchsorted(places, places[low] + most, side="right")) - 1)
        high = min(high, n, low + (rows or n))
        yield low, high
        low = high


def with_keys(df: DataFrame, keys: DataFrame, name: str, rows: int) -> DataFrame:
    """Rows of ``df`` whose key is one of ``keys``, of which there are ``rows``."""
    return df.join(F.broadcast(keys) if rows <= BROADCAST_KEYS else keys, name, "left_semi")


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """The rows with a number each, written once, so that a verdict names one row; and the name
    of the number's column, which no other column has."""
    name, taken = ROW, {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return pinned(docs.withColumn(name, F.monotonically_increasing_id())), name


def without(rows: DataFrame, name: str, gone: DataFrame) -> DataFrame:
    """Of rows numbered by ``name`` those whose number is not in ``gone``, the number dropped."""
    keys = pinned(gone.select(F.col(ROW).alias("_gone_row")))
    small = keys.count() <= BROADCAST_KEYS
    kept = rows.join(F.broadcast(keys) if small else keys, rows[name] == keys["_gone_row"], "left_anti")
    return kept.drop(name)


def with_whole(result: str, given: DataFrame) -> StructType:
    """The columns of ``result``, and the rows themselves if ``given`` has them as ``_all``."""
    return StructType(StructType.fromDDL(result).fields + [f for f in given.schema if f.name == "_all"])


def summed_vectors(parts: DataFrame, key: str = "chunk", value: str = "values") -> DataFrame:
    """Element-wise sum of arrays by key, added up inside tasks before the shuffle.

    ``parts`` has rows (key, values array<double>); one row for each key comes back.
    The arrays of a key must be of one length.
    """
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    vectors = parts.select(key, array_to_vector(value).alias("_v"))
    summed = vectors.groupBy(key).agg(Summarizer.sum(F.col("_v")).alias("_s"))
    return summed.select(key, vector_to_array("_s").alias(value))


def reachable(spark: SparkSession) -> None:
    """Lets Python workers find this package where the driver has it, and take fewer rows at a
    time, if the session has more than TEXTS_PER_BATCH.

    For sessions on one machine that were not started with the package on PYTHONPATH; on a
    cluster it comes with spark-submit (--py-files) or is installed.
    """
    if not 0 < int(spark.conf.get(BATCH_ROWS)) <= TEXTS_PER_BATCH:
        spark.conf.set(BATCH_ROWS, TEXTS_PER_BATCH)
    environment, here = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if here not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([here, *filter(None, paths)])


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


__all__ = [
    "ALPHANUMERIC",
    "BROADCAST_KEYS",
    "NOT_SPACE",
    "ROW",
    "Words",
    "grams",
    "held",
    "mixed",
    "numbered",
    "pinned",
    "reachable",
    "read",
    "slices",
    "summed_vectors",
    "text_bytes",
    "tidy",
    "with_keys",
    "with_whole",
    "without",
]
