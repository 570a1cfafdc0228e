"""Language identification by nearest centroid.

Texts become normalised TF-IDF vectors of hashed byte n-grams. Each language has several
centroids, found by clustering its vectors, and a text has the language of the centroid with the
greatest cosine. A text that is far from all of them is rejected.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rastro.llm.common import SLICE, slices, text_bytes, tidy, with_whole
from rastro.llm.folds import held_out, sampled

#: Vector places, n-gram lengths and centroids for each language.
WIDTH, LENGTHS, CENTROIDS = 4096, (1, 2, 3), 4
#: Texts whose vectors are laid out at a time, however short they are.
TOGETHER = 64
#: Vectors of each language that are clustered, chosen by hash: clusters are made on the driver.
SAMPLE_ROWS = 400
#: Rejected is what has less than this part of the cosine that all but a hundredth of the learned
#: texts of the language, and of pieces of them, have with their centroid at about that length.
REJECTION, QUANTILE = 0.4, 0.01
#: Bytes at which the bound changes. Pieces of the sampled texts stand for the short lengths.
LENGTH_STEPS = (25, 50, 100, 200)
#: Fewer texts than this say little about the words of others: they set one bound, for long texts.
FEW_TEXTS = 20

PARTS, PART = 3, 1
UNKNOWN = "und"
RESULT = "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean"

SAMPLE = pa.schema(
    [("doc_id", pa.int64()), ("piece", pa.int32()), ("lang", pa.string()), ("at", pa.binary()), ("v", pa.binary())]
)

_LETTER = re.compile(r"[^\W\d_]")
# ASCII letters in lower case, other ASCII as space, the rest as it is.
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:128] = 32
_FOLD[65:91] = np.arange(97, 123)
_FOLD[97:123] = np.arange(97, 123)


def counts(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Roots of the n-gram counts, one row for each text."""
    rows, n = len(places) - 1, len(data)
    folded = _FOLD[data]
    if n:
        # Upper case of Latin-1 letters, which have the first byte C3.
        after = np.concatenate(([False], data[:-1] == 0xC3)) & (data >= 0x80) & (data <= 0x9E)
        folded[after] += 0x20
    total = np.zeros(rows * WIDTH, np.float32)
    for length in LENGTHS:
        for low in range(0, max(0, n - length + 1), SLICE):
            high = min(low + SLICE, n - length + 1)
            code = np.full(high - low, length, np.uint32)
            for j in range(length):
                code = (code << np.uint32(8)) | folded[low + j : high + j]
            place = ((code * np.uint32(2654435761)) >> np.uint32(20)).astype(np.int64)
            text = np.searchsorted(places, np.arange(low, high, dtype=np.int64), "right") - 1 if rows > 1 else 0
            place += text * WIDTH
            if rows > 1:
                whole = np.arange(low + length, high + length) <= places[text + 1]
                place = place[whole]
            total += np.bincount(place, minlength=rows * WIDTH)
    return np.sqrt(total).reshape(rows, WIDTH)


def _normal(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.maximum(np.linalg.norm(vectors, axis=-1, keepdims=True), 1e-12)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    languages: list[str]  # of each centroid
    centroids: np.ndarray
    least: np.ndarray  # for each step of length, the cosine below which a centroid rejects

    def judge(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The nearest centroid, its cosine, and whether it is too far."""
        cosines = _normal(vectors * self.weights) @ self.centroids.T
        best = cosines.argmax(1)
        cosine = cosines[np.arange(len(best)), best]
        return best, np.clip(cosine, 0, 1), cosine < self.least[length_steps(vectors), best]


def length_steps(vectors: np.ndarray) -> np.ndarray:
    """The step of each text's length: a byte begins about one n-gram of each length, and counts
    are kept as roots."""
    size = np.square(vectors, dtype=np.float32).sum(1) / len(LENGTHS)
    return np.searchsorted(LENGTH_STEPS, size, side="right")


def pieces_of(text: bytes) -> list[bytes]:
    """The text, and from its middle one piece for each step that it is longer than."""
    middle = len(text) // 2
    whole = [text]
    for low, high in zip((0, *LENGTH_STEPS), LENGTH_STEPS):
        size = (low + high) // 2
        if size < len(text):
            # A piece begins and ends with whole characters.
            piece = text[middle - size // 2 :][:size].decode(errors="ignore")
            whole.append(piece.encode())
    return whole


def clustered(vectors: np.ndarray, k: int, rounds: int = 20) -> tuple[np.ndarray, np.ndarray]:
    """Centroids of unit vectors by cosine, and the cluster of each vector."""
    centroids = _normal(vectors.mean(0, keepdims=True))
    while len(centroids) < min(k, len(vectors)):
        farthest = (vectors @ centroids.T).max(1).argmin()
        centroids = np.concatenate([centroids, vectors[farthest : farthest + 1]])
    for _ in range(rounds):
        of = (vectors @ centroids.T).argmax(1)
        for c in np.unique(of):
            centroids[c] = _normal(vectors[of == c].mean(0))
    return centroids, (vectors @ centroids.T).argmax(1)


def _vectors(batches, column):
    for batch in batches:
        data, places = text_bytes(batch.column(column))
        for low, high in slices(places, SLICE // 2, TOGETHER):
            own = places[low : high + 1]
            yield batch, low, high, counts(data[own[0] : own[-1]], own - own[0])


def learned(docs: DataFrame) -> Model | None:
    """Weights from all texts that may be learned from, centroids from a sample of them."""
    known = docs.filter(F.col("text").isNotNull() & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    known = known.filter(~held_out("doc_id", PARTS, PART)).select("doc_id", "text", "lang")

    def occurrences(batches):
        total, rows = np.zeros(WIDTH, np.int64), 0
        for _, low, high, vectors in _vectors(batches, 1):
            total += (vectors > 0).sum(0)
            rows += high - low
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(-1, WIDTH), pa.int32()), pa.array(np.concatenate(([rows], total)), pa.int64())],
            names=["place", "n"],
        )

    sums = known.mapInArrow(tidy(occurrences), "place int, n long").groupBy("place").agg(F.sum("n").alias("n"))
    found = {r["place"]: r["n"] for r in sums.collect()}  # WIDTH + 1 rows
    if not found.get(-1):
        return None
    seen = np.array([found[i] for i in range(WIDTH)], float)
    weights = np.log((1 + found[-1]) / (1 + seen)).astype(np.float32) + np.float32(0.01)

    keys = sampled(known.select("doc_id", "lang").distinct(), "lang", "doc_id", SAMPLE_ROWS)
    # A fixed number of rows for each language: of an id's texts the least, however many it has.
    chosen = known.join(F.broadcast(keys), ["doc_id", "lang"]).groupBy("doc_id", "lang")
    chosen = chosen.agg(F.min("text").alias("text")).select("doc_id", "text", "lang")

    def vectors_of(batches):
        for batch in batches:
            for key, text, lang in zip(*(c.to_pylist() for c in batch.columns)):
                # The whole text and its pieces, as sparse as they are.
                for piece, part in enumerate(pieces_of(text.encode())):
                    vector = counts(np.frombuffer(part, np.uint8), np.array([0, len(part)]))[0]
                    at = np.flatnonzero(vector).astype(np.int16)
                    yield pa.RecordBatch.from_pylist(
                        [
                            {
                                "doc_id": key,
                                "piece": piece,
                                "lang": lang,
                                "at": at.tobytes(),
                                "v": vector[at].astype(np.float16).tobytes(),
                            }
                        ],
                        schema=SAMPLE,
                    )

    rows = chosen.mapInArrow(tidy(vectors_of), "doc_id long, piece int, lang string, at binary, v binary").toArrow()
    rows = rows.sort_by([("doc_id", "ascending"), ("lang", "ascending"), ("piece", "ascending")])
    langs = np.array(rows.column("lang").to_pylist(), dtype=object)
    whole = np.array(rows.column("piece").to_pylist(), int) == 0
    names, centroids, least = [], [], []
    for lang in sorted(set(langs)):
        mine = np.flatnonzero(langs == lang)
        sample = np.zeros((len(mine), WIDTH), np.float32)
        for vector, i in zip(sample, mine.tolist()):
            vector[np.frombuffer(rows.column("at")[i].as_py(), np.int16)] = np.frombuffer(
                rows.column("v")[i].as_py(), np.float16
            )
        there = sample.any(1)
        sample, steps, own = sample[there], length_steps(sample[there]), whole[mine][there]
        if not own.any():
            continue
        sample = _normal(sample * weights)
        centres, _ = clustered(sample[own], CENTROIDS)
        near = (sample @ centres.T).max(1)
        if own.sum() < FEW_TEXTS:
            near, steps = near[own], np.full(own.sum(), len(LENGTH_STEPS))
        names += [lang] * len(centres)
        centroids.append(centres)
        bounds = []
        for step in range(len(LENGTH_STEPS) + 1):
            like = near[steps == step]
            # A length that nothing was learned of has the bound of the shorter ones; none rejects none.
            bounds.append(REJECTION * float(np.quantile(like, QUANTILE)) if len(like) else (bounds or [0.0])[-1])
        least.append(np.repeat(np.array(bounds)[:, None], len(centres), 1))
    if not names:
        return None
    return Model(weights, names, np.concatenate(centroids).astype(np.float32), np.concatenate(least, 1))


def identify(docs: DataFrame, model: Model | None = None, whole: bool = False) -> DataFrame:
    """doc_id, held_out, lang_pred, score (cosine, 0 to 1) and rejected for every document.

    Learned from text and language of documents whose crc32(doc_id) modulo PARTS is not PART; a
    prediction depends on the text alone. Null texts and texts without a letter are ``und`` with
    score 0 and rejected, as is everything if there is nothing to learn from. Rejected as well
    are texts that are far from every centroid, for their length; they still name the nearest.
    With ``whole`` the row itself is ``_all``. Equal cosines go to the first language by name. Rows without an id are judged and never learned from; repeated rows are judged
    alike; long texts are counted slice by slice; an empty table gives an empty table. Columns
    other than doc_id, text and lang are not read.
    """
    model = model or learned(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judge(batches):
        known = shared.value
        for batch, low, high, vectors in _vectors(batches, 2):
            texts = batch.column(2).slice(low, high - low).to_pylist()
            letters = np.array([bool(t and _LETTER.search(t)) for t in texts], dtype=bool)
            if known is None:
                best, score, far = np.zeros(len(texts), int), np.zeros(len(texts)), ~letters
                letters = np.zeros(len(texts), dtype=bool)
            else:
                best, score, far = known.judge(vectors)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(low, high - low),
                    batch.column(1).slice(low, high - low),
                    pa.array(
                        [known.languages[b] if x else UNKNOWN for b, x in zip(best, letters)], pa.string()
                    ),
                    pa.array(np.where(letters, score, 0.0).astype(float), pa.float64()),
                    pa.array(far | ~letters, pa.bool_()),
                    *(c.slice(low, high - low) for c in batch.columns[3:]),
                ],
                names=["doc_id", "held_out", "lang_pred", "score", "rejected", *batch.schema.names[3:]],
            )

    given = docs.select(
        F.col("doc_id").cast("long"),
        held_out("doc_id", PARTS, PART).alias("held_out"),
        "text",
        *([F.struct(*(docs[c] for c in docs.columns)).alias("_all")] if whole else []),
    )
    return given.mapInArrow(tidy(judge), with_whole(RESULT, given))


def recognised(docs: DataFrame) -> DataFrame:
    """The rows that are not rejected, each judged by its own whole text, with an id or without,
    all their columns kept, whatever their names. Equal rows stay or go together."""
    return identify(docs, whole=True).filter("NOT rejected").select("_all.*")
