"""Quality by compression: dictionaries of good and of bad text.

A text is compressed twice with zstandard, once with a dictionary trained on good and once with
one trained on bad labelled texts. The normalised difference of the two sizes says which side it
resembles; with the text's own compression rate beside it, a logistic curve fitted on other
labelled texts turns it into a probability.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rastro.llm.common import held, text_bytes, tidy, with_whole
from rastro.llm.folds import held_out, sampled

#: Labelled texts of each class that are learned from, chosen by hash, and the bytes of the
#: longest among them: the model is fitted on the driver.
SAMPLE_ROWS = 3000
SAMPLE_BYTES = 65_536
#: Bytes of the longest text that goes into a dictionary: a few long ones would fill it.
ENTRY_BYTES = 8192
DICTIONARY_BYTES = 112_640
LEVEL = 1

PARTS, PART = 4, 2
ACCEPTED = 0.7
RESULT = "doc_id long, held_out boolean, score double, predicted int"


@dataclass(frozen=True)
class Model:
    dictionaries: tuple[bytes, bytes]  # of label 0 and 1
    raw: tuple[bool, bool]
    mean: tuple[float, ...]
    deviation: tuple[float, ...]
    weights: tuple[float, ...]  # the first is the constant
    level: int

    def scores(self, data: np.ndarray, places: np.ndarray) -> np.ndarray:
        x = (_features(_sizes(self, data, places)) - self.mean) / self.deviation
        return _curve(self.weights[0] + x @ np.array(self.weights[1:]))


def _curve(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _compressors(model: Model):
    for data, raw in zip(model.dictionaries, model.raw):
        kind = zstandard.DICT_TYPE_RAWCONTENT if raw else zstandard.DICT_TYPE_FULLDICT
        dictionary = zstandard.ZstdCompressionDict(data, dict_type=kind)
        yield zstandard.ZstdCompressor(
            dict_data=dictionary,
            level=model.level,
            write_content_size=False,
            write_checksum=False,
            write_dict_id=False,
        )


def _sizes(model: Model, data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Sizes with the dictionary of label 0, of label 1, and of the text itself."""
    whole = memoryview(np.ascontiguousarray(data))
    bad, good = held(("compressors", model), lambda: list(_compressors(model)))
    out = np.empty((len(places) - 1, 3))
    for i, (low, high) in enumerate(zip(places[:-1].tolist(), places[1:].tolist())):
        text = whole[low:high]
        out[i] = len(bad.compress(text)), len(good.compress(text)), high - low
    return out


def _features(sizes: np.ndarray) -> np.ndarray:
    bad, good, own = sizes.T
    difference = (bad - good) / (bad + good + 20)
    rate = np.log((np.minimum(bad, good) + 10) / (own + 10))
    return np.stack([difference, rate, difference**2, rate**2, difference * rate], 1)


def _dictionary(texts: list[bytes], size: int) -> tuple[bytes, bool]:
    """A trained dictionary; the texts themselves, if they are too few to train on."""
    try:
        return zstandard.train_dictionary(size, texts).as_bytes(), False
    except zstandard.ZstdError:
        return b"".join(texts)[-size:] or b" " * 8, True


def fit(learn: list[tuple[int, bytes, int]], level: int = LEVEL) -> Model:
    """A model from rows (id, text, label). Two of three rows go into the dictionaries, the
    others fit the curve, as texts inside a dictionary compress too well."""
    rows = sorted(learn)
    texts = [
        [t for i, (_, t, y) in enumerate(rows) if i % 3 and y == label and len(t) <= ENTRY_BYTES]
        for label in (0, 1)
    ]
    (bad, bad_raw), (good, good_raw) = (_dictionary(t, DICTIONARY_BYTES) for t in texts)
    blank = Model((bad, good), (bad_raw, good_raw), (0.0,) * 5, (1.0,) * 5, (0.0,) * 6, level)
    held = [(t, y) for i, (_, t, y) in enumerate(rows) if i % 3 == 0]
    if not held:
        return blank
    data = np.frombuffer(b"".join(t for t, _ in held), np.uint8)
    places = np.concatenate(([0], np.cumsum([len(t) for t, _ in held])))
    x, y = _features(_sizes(blank, data, places)), np.array([y for _, y in held], float)
    mean, deviation = x.mean(0), x.std(0) + 1e-9
    x = np.column_stack([np.ones(len(x)), (x - mean) / deviation])
    weights, small = np.zeros(x.shape[1]), 1e-3 * len(y) / 100 + 1e-3
    for _ in range(50):
        p = _curve(x @ weights)
        slope = x.T @ (x * (p * (1 - p) + 1e-6)[:, None]) + small * np.eye(len(weights))
        step = np.linalg.solve(slope, x.T @ (y - p) - small * weights)
        weights += step / max(1.0, np.abs(step).max() / 5)
    return Model(
        blank.dictionaries, blank.raw, tuple(mean), tuple(deviation), tuple(weights), level
    )


def learned(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from the labelled documents that are not held out.

    About SAMPLE_ROWS texts of each class, none longer than SAMPLE_BYTES. Labels other than 0
    and 1 are left out; a document with both counts as good, and one with several texts has the
    least of them.
    """
    known = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    known = known.filter(~held_out("doc_id", PARTS, PART))
    known = known.groupBy("doc_id").agg(F.max("quality").alias("_label"))
    # A fixed number of rows, so they are sent to the documents.
    chosen = F.broadcast(sampled(known, "_label", "doc_id", SAMPLE_ROWS))
    texts = docs.select("doc_id", "text").filter(F.octet_length("text") <= SAMPLE_BYTES)
    # One text of each id, the least, however often the id is repeated.
    rows = texts.join(chosen, "doc_id").groupBy("doc_id", "_label").agg(F.min("text").alias("text")).toArrow()
    return fit(
        [
            (i, t.encode(), y)
            for i, t, y in zip(*(rows.column(c).to_pylist() for c in ("doc_id", "text", "_label")))
        ]
    )


def quality(
    docs: DataFrame, labels: DataFrame, model: Model | None = None, whole: bool = False
) -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher for good text) and predicted for every document.

    Labels are learned from documents whose crc32(doc_id) modulo PARTS is not PART; a score
    depends on the text alone. Null texts are scored as empty ones. Without labels every score
    is 0.5. Rows without an id are scored and never learned from; repeated rows are scored each
    and equally; a long text is compressed as a whole, by itself; an empty table gives an empty
    table. Columns other than doc_id and text, and quality of the labels, are not read. With ``whole`` the row itself is ``_all``.
    """
    model = model or learned(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        for batch in batches:
            scores = shared.value.scores(*text_bytes(batch.column(2)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(scores, pa.float64()),
                    pa.array((scores >= ACCEPTED).astype(np.int32), pa.int32()),
                    *batch.columns[3:],
                ],
                names=["doc_id", "held_out", "score", "predicted", *batch.schema.names[3:]],
            )

    given = docs.select(
        F.col("doc_id").cast("long"),
        held_out("doc_id", PARTS, PART).alias("held_out"),
        "text",
        *([F.struct(*(docs[c] for c in docs.columns)).alias("_all")] if whole else []),
    )
    return given.mapInArrow(tidy(score, holds=True), with_whole(RESULT, given))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows that are not scored below ACCEPTED, each by its own text, all their columns kept."""
    judged = quality(docs, labels, whole=True)
    return judged.filter("predicted <> 0").select("_all.*")
