"""What a Python worker holds: an executor has several, beside the heap."""

import threading
import tracemalloc

import numpy as np
import pyarrow as pa

from rastro.llm import common, language, ngram_join, packing
from rastro.llm.queries import vocabulary


def batch(texts):
    return pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])


def traced(work):
    tracemalloc.start()
    out = work()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return out, peak


def test_vectors_of_many_short_texts_are_laid_out_a_few_at_a_time():
    texts = [f"the short text number {i}" for i in range(common.TEXTS_PER_BATCH)]

    def count():
        return [(low, high) for _, low, high, v in language._vectors([batch(texts)], 0) if len(v) == high - low]

    runs, peak = traced(count)
    assert [i for low, high in runs for i in range(low, high)] == list(range(len(texts)))
    assert peak < 12 << 20


def test_vectors_do_not_depend_on_the_slices():
    texts = ["", "One text.", "Ärger und Übermut. " * 30, None, "x"] * 40
    data, places = common.text_bytes(pa.array(texts, pa.string()))
    whole = language.counts(data, places)
    sliced = np.concatenate([v for *_, v in language._vectors([batch(texts)], 0)])
    assert np.array_equal(whole, sliced)


def test_sets_of_a_batch_take_little_beside_it():
    texts = [" ".join(f"w{i * j % 997}" for j in range(600)) for i in range(500)]
    common._POWERS.clear()
    n, peak = traced(lambda: sum(len(s) for _, _, _, sets in ngram_join._sets([batch(texts)], 0, 5) for s in sets))
    assert n > 200_000 and peak < 40 << 20


def test_a_stage_drops_what_another_left():
    common.held("another stage", lambda: "large")
    seen = []
    work = common.tidy(lambda batches: (seen.append(dict(common._HELD)) or b for b in batches))
    assert list(work([1, 2])) == [1, 2] and seen == [{}, {}]
    common.held("this stage", lambda: "large")
    holding = common.tidy(lambda batches: (common.held("this stage", int) for _ in batches), holds=True)
    assert list(holding([1, 2])) == ["large", "large"] and "this stage" in common._HELD
    common._HELD.clear()


def test_what_the_driver_holds_is_not_sent(spark, table):
    common.held("of the driver", threading.Lock)
    rows = table([(i, f"some words of the text {i}") for i in range(20)], {i: "en" for i in range(20)})
    assert language.identify(rows).count() == 20 and "of the driver" in common._HELD
    common._HELD.clear()


def test_packing_starts_no_workers_for_its_places(spark, table):
    packed = packing.pack(table([(i, "some words " * (i + 1)) for i in range(20)]), vocabulary())
    plan = packed._jdf.queryExecution().toString()
    assert packed.count() == 20 and "ExistingRDD" not in plan and "PythonRDD" not in plan
