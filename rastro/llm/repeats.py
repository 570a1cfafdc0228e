"""Passages that occur more than once, found by super-k-mers, and texts without them.

A window is ``words`` consecutive words. Its minimiser is the least of its grams of ``GRAM``
words, by hash, the first of equals. Consecutive windows with one minimiser overlap in all but a
word each, so they travel as one string, a super-k-mer, to the bucket of the minimiser; equal
windows meet there, and sorting them counts them exactly, on their bytes.

Grams that many texts hold come last in the order. A window has such a minimiser only if all its
grams are frequent: a window that reaches beyond a frequent passage goes to a bucket of its own,
and those inside it form the same strings everywhere, of which a task sends one. So a bucket gets
a few rows from each task, however many texts share a passage or are copies.

Verdicts return by the SHA-256 of the whole text, not by row: texts are read again for them, and
the table needs no numbers and is not written.
"""

from __future__ import annotations

import math
import struct
from collections import defaultdict
from hashlib import sha256

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rastro.llm.common import NOT_SPACE, Words, grams, mixed, pinned, slices, text_bytes

#: Words of a window, and of the grams that minimisers are.
WORDS, GRAM = 35, 4
#: Buckets travel in parts; so many for each shuffle partition.
PARTS = 4
#: Bytes of super-k-mers that a task holds back to send equal ones once.
HELD_BYTES = 32 << 20
#: Windows longer than this are sorted by their SHA-256.
LONG_WINDOW = 1024

KEY_BYTES = 16


def _parts(docs: DataFrame) -> int:
    return PARTS * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _texts(batches, column: int):
    """Words of runs of texts, with the batch and the run's place in it."""
    for batch in batches:
        data, places = text_bytes(batch.column(column))
        for low, high in slices(places):
            own = places[low : high + 1]
            run = data[own[0] : own[-1]]
            yield batch, low, run, Words(run, own - own[0], NOT_SPACE)


def frequent_slots(docs: DataFrame, parts: int, gram: int = GRAM) -> tuple[int, list[int]]:
    """(bits, slots): the top bits of grams that make up more than a quarter of a part.

    All grams of all texts are counted. A task reports the slots that hold half of that share of
    its own grams; a slot beyond the share over all tasks is missed by none of its halves, and
    at most ``8 * parts`` slots come to the driver.
    """
    bits = min(26, max(18, math.ceil(math.log2(64 * parts))))
    share = 1 / (4 * parts)

    def count(batches):
        counts = np.zeros(1 << bits, np.uint32)
        for _, _, _, words in _texts(batches, 0):
            slots = (grams(words.hash, gram) >> np.uint64(64 - bits)).astype(np.int64)
            np.add.at(counts, slots, np.uint32(1))
        total = int(counts.sum())
        found = np.flatnonzero(counts >= max(2, total * share / 2))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.append(found, -1), pa.int64()),
                pa.array(np.append(counts[found].astype(np.int64), total), pa.int64()),
            ],
            names=["slot", "n"],
        )

    reported = docs.select("text").mapInArrow(count, "slot long, n long")
    sums = pinned(reported.groupBy("slot").agg(F.sum("n").alias("n")))
    total = sums.filter("slot = -1").first()
    if total is None:
        return bits, []
    hot = sums.filter((F.col("slot") >= 0) & (F.col("n") >= max(2, total["n"] * share / 2)))
    return bits, sorted(r["slot"] for r in hot.select("slot").collect())


def super_kmers(words: Words, size: int, gram: int, last: np.ndarray, bits: int):
    """(first window, number of windows, minimiser) of each run, as arrays over the words' places."""
    order = grams(words.hash, gram)
    across = size - gram + 1
    n = len(words.hash) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    slots = (order >> np.uint64(64 - bits)).astype(np.int64)
    order = (order >> np.uint64(1)) | (last[slots].astype(np.uint64) << np.uint64(63))
    text_end = np.repeat(words.of[1:], np.diff(words.of))[:n]
    inside = np.arange(n) + size <= text_end
    at = np.arange(n) + np.lib.stride_tricks.sliding_window_view(order, across).argmin(axis=1)
    new = inside.copy()
    new[1:] &= (at[1:] != at[:-1]) | ~inside[:-1]
    first = np.flatnonzero(new)
    # A run ends before the next one or before a window that is none.
    stop = np.flatnonzero(np.append(inside[:-1] & (new[1:] | ~inside[1:]), inside[-1])) + 1
    return first, stop - first, order[at[first]]


def _spaced(run: np.ndarray, words: Words) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words of a run one space apart, and where each begins and ends."""
    lengths = words.end - words.start
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    source = np.arange(len(lengths) and int(ends[-1]) + 1)
    source += np.repeat(words.start - starts, lengths + 1)
    out = run[np.minimum(source, max(len(run) - 1, 0))]
    out[ends] = 0x20
    return out.tobytes(), starts, ends


class _Sender:
    """Super-k-mers of a task: equal strings are sent once, with the weight 2; the places of all
    but single ones are settled here and go on as ranges."""

    def __init__(self, parts: int) -> None:
        self.parts = parts
        self.press = zstandard.ZstdCompressor(3)
        self.reset()

    def reset(self) -> None:
        self.index: dict[bytes, int] = {}
        self.buckets, self.keys, self.starts, self.counts = [], [], [], []
        self.twice = bytearray()
        self.times: dict[bytes, int] = {}
        self.settled: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        self.held = 0

    def add(self, key: bytes, bucket: int, string: bytes, start: int, count: int) -> None:
        at = self.index.get(string)
        if at is None:
            self.index[string] = len(self.buckets)
            self.buckets.append(bucket)
            self.keys.append(key)
            self.starts.append(start)
            self.counts.append(count)
            self.twice.append(0)
            self.held += len(string) + 200
        else:
            self.twice[at] = 1
            self.settled[key].append((start, start + count))
            self.held += 100

    def again(self, key: bytes) -> bool:
        """Whether two equal texts are held already: a third one adds nothing."""
        times = self.times[key] = self.times.get(key, 0) + 1
        return times > 2

    def flush(self):
        """Rows (part, blob)."""
        for at in np.flatnonzero(np.frombuffer(bytes(self.twice), np.uint8)).tolist():
            self.settled[self.keys[at]].append((self.starts[at], self.starts[at] + self.counts[at]))
        strings = list(self.index)
        buckets = np.array(self.buckets, np.uint64)
        part = (mixed(buckets) % np.uint64(self.parts)).astype(np.int64)
        forward: dict[int, list[bytes]] = defaultdict(list)
        for key in self.settled:
            forward[int.from_bytes(key[:4], "little") % self.parts].append(key)
        order = np.argsort(part, kind="stable")
        borders = np.searchsorted(part[order], np.arange(self.parts + 1))
        starts, twice = np.array(self.starts, np.int32), np.frombuffer(bytes(self.twice), np.uint8)
        out_parts, blobs = [], []
        for p in range(self.parts):
            rows = order[borders[p] : borders[p + 1]]
            own = rows.tolist()
            if not own and p not in forward:
                continue
            mine = [strings[i] for i in own]
            ranges = [(key, _merged(self.settled[key])) for key in forward.get(p, ())]
            blob = b"".join(
                [
                    struct.pack("<ii", len(own), len(ranges)),
                    buckets[rows].tobytes(),
                    starts[rows].tobytes(),
                    twice[rows].tobytes(),
                    np.array([len(s) for s in mine], np.int32).tobytes(),
                    b"".join(b"\0" * KEY_BYTES if self.twice[i] else self.keys[i] for i in own),
                    b"".join(mine),
                    *(k + struct.pack("<i", len(r)) + r.tobytes() for k, r in ranges),
                ]
            )
            out_parts.append(p)
            blobs.append(self.press.compress(blob))
            if len(blobs) == 1000:
                yield _blobs(out_parts, blobs)
                out_parts, blobs = [], []
        if blobs:
            yield _blobs(out_parts, blobs)
        self.reset()


def _blobs(parts: list[int], blobs: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(parts, pa.int32()), pa.array(blobs, pa.binary())], names=["part", "blob"]
    )


def _merged(ranges: list[tuple[int, int]]) -> np.ndarray:
    """Ranges [low, high) put together where they touch, one after the other in one array."""
    ordered = np.array(sorted(ranges), np.int32).reshape(-1, 2)
    reach = np.maximum.accumulate(ordered[:, 1])
    new = np.append(True, ordered[1:, 0] > reach[:-1])
    return np.stack([ordered[new, 0], reach[np.append(np.flatnonzero(new)[1:] - 1, -1)]], 1).ravel()


class _Part:
    """All that came for one part."""

    def __init__(self) -> None:
        self.rows: list[tuple[int, bytes, int, int, bytes]] = []
        self.ranges: dict[bytes, list[tuple[int, int]]] = defaultdict(list)

    def add(self, blob: bytes) -> None:
        n, settled = struct.unpack_from("<ii", blob)
        at = 8
        columns = []
        for kind in (np.uint64, np.int32, np.uint8, np.int32):
            columns.append(np.frombuffer(blob, kind, n, at).tolist())
            at += n * np.dtype(kind).itemsize
        keys, at = at, at + n * KEY_BYTES
        for i, (bucket, start, twice, length) in enumerate(zip(*columns)):
            key = blob[keys + i * KEY_BYTES : keys + (i + 1) * KEY_BYTES]
            self.rows.append((bucket, blob[at : at + length], twice, start, key))
            at += length
        for _ in range(settled):
            key, size = blob[at : at + KEY_BYTES], struct.unpack_from("<i", blob, at + KEY_BYTES)[0]
            at += KEY_BYTES + 4
            pairs = np.frombuffer(blob, np.int32, size, at).reshape(-1, 2).tolist()
            self.ranges[key].extend(map(tuple, pairs))
            at += 4 * size

    def settle(self, size: int) -> None:
        """Adds the ranges of windows that occur more than once in these buckets."""
        self.rows.sort(key=lambda r: r[:2])
        low = 0
        while low < len(self.rows):
            high = low + 1
            while high < len(self.rows) and self.rows[high][0] == self.rows[low][0]:
                high += 1
            if high - low > 1:
                self._bucket(self.rows[low:high], size)
            low = high

    def _bucket(self, rows, size: int) -> None:
        strings: dict[bytes, list] = {}
        for _, string, twice, start, key in rows:
            own = strings.setdefault(string, [0, set()])
            own[0] += 2 if twice else 1
            if not twice:
                own[1].add((key, start))
        repeated: dict[bytes, set[int]] = defaultdict(set)
        if len(strings) > 1:
            windows = sorted((w, i, s) for s in strings for i, w in enumerate(_windows(s, size)))
            for (w, i, s), (other, j, t) in zip(windows, windows[1:]):
                if w == other:
                    repeated[s].add(i)
                    repeated[t].add(j)
        for string, (weight, places) in strings.items():
            if weight > 1:
                own = [(0, string.count(b" ") + 2 - size)]
            else:
                own = [(i, i + 1) for i in sorted(repeated.get(string, ()))]
            for key, start in places if own else ():
                self.ranges[key].extend((start + a, start + b) for a, b in own)


def _windows(string: bytes, size: int):
    ends = np.flatnonzero(np.frombuffer(string, np.uint8) == 0x20).tolist()
    for low, high in zip([0, *(e + 1 for e in ends)], [*ends, len(string)][size - 1 :]):
        window = string[low:high]
        yield window if high - low <= LONG_WINDOW else sha256(window).digest()


def repeated_windows(docs: DataFrame, words: int = WORDS, gram: int = GRAM) -> DataFrame:
    """(key, ranges): for texts that hold windows occurring more than once, by the first bytes
    of the text's SHA-256, arrays of ranges [low, high) of such windows, as 32-bit numbers.

    ``docs`` has the columns key and text. Its texts are read twice, once to count grams.
    """
    if words < gram:
        raise ValueError(f"a window needs {gram} words at least")
    parts = _parts(docs)
    bits, hot = frequent_slots(docs, parts, gram)

    def send(batches):
        last = np.zeros(1 << bits, bool)
        last[hot] = True
        sender = _Sender(parts)
        for batch, low, run, own in _texts(batches, 1):
            first, count, bucket = super_kmers(own, words, gram, last, bits)
            if not len(first):
                continue
            spaced, starts, ends = _spaced(run, own)
            text = np.searchsorted(own.of, first, side="right") - 1
            begins = (first - own.of[text]).tolist()
            froms, tos = starts[first].tolist(), ends[first + count + words - 2].tolist()
            of, skip, key = -1, False, b""
            for t, b, f, to, at, n in zip(
                text.tolist(), bucket.tolist(), froms, tos, begins, count.tolist()
            ):
                if t != of:
                    if sender.held > HELD_BYTES:
                        yield from sender.flush()
                    key = batch.column(0)[low + t].as_py()
                    of, skip = t, sender.again(key)
                if not skip:
                    sender.add(key, b, spaced[f:to], at, n)
        yield from sender.flush()

    def meet(batches):
        part, at = _Part(), None
        unpress = zstandard.ZstdDecompressor()
        for batch in batches:
            for p, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                if p != at:
                    yield from _verdicts(part, words)
                    part, at = _Part(), p
                part.add(unpress.decompress(blob.as_py()))
        yield from _verdicts(part, words)

    sent = docs.select("key", "text").mapInArrow(send, "part int, blob binary")
    met = sent.repartition(parts // PARTS, "part").sortWithinPartitions("part")
    found = met.mapInArrow(meet, "key binary, ranges binary")
    return found.groupBy("key").agg(F.collect_list("ranges").alias("ranges"))


def _verdicts(part: _Part, size: int):
    part.settle(size)
    if part.ranges:
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(part.ranges), pa.binary()),
                pa.array([_merged(r).tobytes() for r in part.ranges.values()], pa.binary()),
            ],
            names=["key", "ranges"],
        )


def without_repeats(docs: DataFrame, words: int = WORDS, gram: int = GRAM) -> DataFrame:
    """doc_id, n_words, n_removed, kept, removed: each text without its repeated passages.

    A word goes if a window of ``words`` words that covers it also starts elsewhere, in the same
    text or another; all windows are judged on the input. ``kept`` has the other words, one space
    apart; ``removed`` the ranges [low, high) of the words that went. Words are runs of other
    characters than space and 09 to 0D, with their case.

    One row for each row of ``docs``, whether its id is null or repeated; a text that two rows
    hold is repeated, with ``words`` words at least. Null, empty, blank and short texts keep all
    their words. A very long text costs its own size; a text that repeats itself has its windows
    counted like others. Columns other than doc_id and text are not read; an empty table gives an
    empty one.
    """
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
        # Texts without room for a window have no verdict to wait for.
        F.when(
            F.octet_length("text") >= 2 * words - 1,
            F.substring(F.unhex(F.sha2(F.col("text").cast("binary"), 256)), 1, KEY_BYTES),
        ).alias("key"),
    )
    verdicts = pinned(repeated_windows(texts.filter("key IS NOT NULL"), words, gram))

    def strip(batches):
        for batch in batches:
            ids = batch.column(0)
            data, places = text_bytes(batch.column(1))
            for low, high in slices(places):
                own = places[low : high + 1] - places[low]
                run = data[places[low] : places[high]]
                yield _stripped(ids[low:high], run, Words(run, own, NOT_SPACE), batch.column(2)[low:high], words)

    judged = texts.join(verdicts, "key", "left").select("doc_id", "text", "ranges")
    return judged.mapInArrow(
        strip, "doc_id long, n_words long, n_removed long, kept string, removed array<struct<low:int,high:int>>"
    )


def _stripped(ids, run, own: Words, ranges, size: int) -> pa.RecordBatch:
    spaced, starts, ends = _spaced(run, own)
    counts, removed, kept, spans = [], [], [], []
    for low, high, blobs in zip(own.of[:-1].tolist(), own.of[1:].tolist(), ranges.to_pylist()):
        n = high - low
        counts.append(n)
        if not blobs:
            removed.append(0)
            kept.append(spaced[starts[low] : ends[high - 1]] if n else b"")
            spans.append([])
            continue
        pairs = np.concatenate([np.frombuffer(b, np.int32) for b in blobs]).reshape(-1, 2)
        # A window covers the words after its own first one, too.
        covered = _merged([(a, b + size - 1) for a, b in pairs.tolist()]).reshape(-1, 2).tolist()
        gone = sum(b - a for a, b in covered)
        left = zip([0, *(b for _, b in covered)], [*(a for a, _ in covered), n])
        removed.append(gone)
        kept.append(b" ".join(spaced[starts[low + a] : ends[low + b - 1]] for a, b in left if a < b))
        spans.append([{"low": a, "high": b} for a, b in covered])
    return pa.RecordBatch.from_arrays(
        [
            ids,
            pa.array(counts, pa.int64()),
            pa.array(removed, pa.int64()),
            pa.array(kept, pa.binary()).cast(pa.string()),
            pa.array(spans, pa.list_(pa.struct([("low", pa.int32()), ("high", pa.int32())]))),
        ],
        names=["doc_id", "n_words", "n_removed", "kept", "removed"],
    )
