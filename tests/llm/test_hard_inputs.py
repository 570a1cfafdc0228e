"""Inputs that break shortcuts: long words, deep pages, repeated ids, short foreign texts."""

import time
import tracemalloc

import numpy as np
import pytest

from rastro.llm import decontamination, html_text, language, ngram_join, quality
from rastro.llm.common import NOT_SPACE, Words


def twins(n=11):
    """Two words of 2^n letters whose sums of powers modulo 2^64 agree for any odd base."""
    signs = [bin(i).count("1") % 2 for i in range(1 << n)]
    return "".join("ab"[s] for s in signs), "".join("ba"[s] for s in signs)


def test_long_words_have_hashes_of_their_own():
    data = " ".join((*twins(), *twins())).encode()
    hashes = Words(np.frombuffer(data, np.uint8), np.array([0, len(data)]), NOT_SPACE).hash
    assert len(set(hashes.tolist())) == 2 and hashes[0] == hashes[2] and hashes[1] == hashes[3]


def test_like_sums_are_no_links_and_no_hits(spark, table):
    one, other = twins()
    text = "some words before {} and some words behind it so that the text is long enough"
    docs = table([(1, one), (2, other), (3, text.format(one))])
    found = {r.doc_id: r.component_id for r in ngram_join.near_duplicates(docs).collect()}
    assert found == {1: 1, 2: 2, 3: 3}
    items = spark.createDataFrame([("x", text.format(other)), ("y", text.format(one))], "item_id string, text string")
    hits = {r.doc_id: r.n_hit for r in decontamination.contamination(docs, items.filter("item_id = 'x'")).collect()}
    assert hits == {1: 0, 2: 0, 3: 0}
    hits = {r.doc_id: r.n_hit for r in decontamination.contamination(docs, items).collect()}
    assert hits == {1: 0, 2: 0, 3: 16}


@pytest.mark.parametrize("name", ["div", "div class='ad'", "b", "li"])
def test_deep_pages_cost_their_elements(name):
    page = "<html><body>" + f"<{name}>a few words here. " * 20_000
    tracemalloc.start()
    before = time.process_time()
    text = html_text.main_text(page)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 << 20 and time.process_time() - before < 30
    assert text.count("words") in (0, 20_000) or name == "div"


def test_repeated_ids_do_not_grow_the_sample(spark, table, monkeypatch):
    """One id with very many rows is one row of what is learned."""
    ids = [i for i in range(400) if not language_held(i)][:60]
    rows = [(i, f"this is the text number {i} of the language and of its words") for i in ids]
    rows += [(ids[0], f"this is yet another text of that id, with the number {j}") for j in range(300)]
    docs = table(rows, {i: "en" for i in ids})
    seen = []
    real = language.clustered
    monkeypatch.setattr(language, "clustered", lambda v, k: seen.append(len(v)) or real(v, k))
    assert language.learned(docs) is not None
    assert seen == [60]
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, quality int")
    fitted = []
    monkeypatch.setattr(quality, "fit", lambda rows: fitted.append(len(rows)))
    quality.learned(docs, labels)
    assert 0 < fitted[0] <= 60


def language_held(i):
    import zlib

    return zlib.crc32(str(i).encode()) % 3 == 1


def test_short_foreign_texts_are_rejected_and_short_own_ones_are_not(spark, table):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.learned(docs)
    assert model.least.shape == (len(language.LENGTH_STEPS) + 1, len(model.languages))
    foreign = ["这是一个关于语言识别的短文本我们希望它被拒绝因为没有学过这种语言" * n for n in (1, 2, 5)]
    foreign += ["Съешь же ещё этих мягких французских булок"[:n] for n in (30, 42)]
    own = ["the house of the man", "it is one of the first that was said in the town", "they were there and had been for a year"]
    rows = list(enumerate(foreign + own))
    found = {r.doc_id: r for r in language.identify(table(rows), model).collect()}
    assert [found[i].rejected for i, _ in rows] == [True] * len(foreign) + [False] * len(own)
    # What is learned from, and what is not, stays.
    judged = language.identify(docs, model)
    assert judged.filter("rejected").count() <= 0.001 * docs.count()


def test_row_numbers_take_no_name(spark, table):
    docs = table([(1, "one and the same text of some words"), (1, "one and the same text of some words"), (2, "x")])
    docs = docs.withColumnRenamed("score", "_row_number_")
    for kept in (ngram_join.one_of_each(docs), decontamination.decontaminated(docs, docs.limit(0).selectExpr("'' item_id", "text"))):
        assert kept.columns == docs.columns
        assert {(r["_row_number"], r["_row_number_"]) for r in kept.collect()} == {("x", "x")}
