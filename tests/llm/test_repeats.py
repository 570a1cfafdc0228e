"""Substring dedup against a count of all windows."""

import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from rastro.llm import repeats
from rastro.llm.common import NOT_SPACE, Words


def plain(texts, size):
    """(n_words, n_removed, kept) of each text."""
    split = [[w for w in (t or "").replace("\t", " ").replace("\n", " ").split(" ") if w] for t in texts]
    seen = Counter(tuple(w[i : i + size]) for w in split for i in range(len(w) - size + 1))
    out = []
    for w in split:
        gone = {
            p
            for i in range(len(w) - size + 1)
            if seen[tuple(w[i : i + size])] > 1
            for p in range(i, i + size)
        }
        out.append((len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)))
    return out


def held(spark, table, texts, size, gram):
    found = repeats.without_repeats(table(list(enumerate(texts))), size, gram).collect()
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in found}
    for r in found:
        assert sum(s["high"] - s["low"] for s in r["removed"]) == r["n_removed"]
    assert got == dict(enumerate(plain(texts, size)))


def test_equals_counting_all_windows(spark, table):
    draw = random.Random(1)
    stock = [f"w{i}" for i in range(30)] + ["é", "W1", "\0", "ß" * 9]
    passage = draw.choices(stock, k=40)
    texts = []
    for i in range(80):
        words = draw.choices(stock[: draw.choice([2, 5, 34])], k=draw.randrange(0, 60))
        if i % 3 == 0:
            words[5:5] = passage
        texts.append(draw.choice([" ", "  ", "\n", " \t"]).join(words))
    texts += [texts[0]] * 5 + ["a b " * 50, "a " * 99, "b a b a"]
    held(spark, table, texts, 5, 2)
    held(spark, table, texts, 9, 4)
    held(spark, table, texts, 35, 4)


def test_a_passage_in_most_texts_and_flushes_in_between(spark, table, monkeypatch):
    draw = random.Random(2)
    passage = " ".join(f"p{i}" for i in range(12))
    texts = [
        " ".join([*(f"x{draw.randrange(10**6)}" for _ in range(8)), passage, f"y{i}", "z"]) for i in range(300)
    ]
    held(spark, table, texts, 6, 2)
    monkeypatch.setattr(repeats, "HELD_BYTES", 100)
    held(spark, table, texts[:60] * 2, 6, 2)


def test_frequent_grams_come_last(spark, table):
    texts = [" ".join([f"a{i}", f"b{i}", "the same four words", f"c{i}", f"d{i}"]) for i in range(200)]
    bits, hot = repeats.frequent_slots(table(list(enumerate(texts))), 16, 2)
    last = np.zeros(1 << bits, bool)
    last[hot] = True
    assert 1 <= len(hot) <= 8 * 16
    data = np.frombuffer(texts[0].encode(), np.uint8)
    words = Words(data, np.array([0, len(data)]), NOT_SPACE)
    first, count, bucket = repeats.super_kmers(words, 6, 2, last, bits)
    assert count.sum() == 3
    # Each window reaches beyond the passage and so has a minimiser of its own.
    assert not any(b >> np.uint64(63) for b in bucket)


def test_odd_rows(spark, table, odd_rows):
    found = repeats.without_repeats(table(odd_rows), 10, 4)
    assert found.columns == ["doc_id", "n_words", "n_removed", "kept", "removed"]
    rows = found.collect()
    assert len(rows) == len(odd_rows)
    by_id = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert by_id[0]["n_removed"] == by_id[1]["n_removed"] == 10 and by_id[0]["kept"] == ""
    assert by_id[2]["n_words"] == by_id[3]["n_words"] == by_id[4]["n_words"] == 0
    assert by_id[7]["n_words"] == by_id[7]["n_removed"] == 260_000
    assert [r["kept"] for r in rows if r["doc_id"] is None].count("a text without an id") == 1
    assert repeats.without_repeats(table([])).count() == 0


def test_long_words_and_windows(spark, table):
    long = " ".join(c * 5_000 for c in "abcdefghij")
    held(spark, table, [long, "x " + long + " y", long[:-1], "k " * 3 + long], 4, 2)


def test_batches_and_partitions_do_not_matter(spark, sample):
    docs = sample("documents")
    whole = repeats.without_repeats(docs).select("doc_id", F.sha2("kept", 256)).collect()
    dealt = repeats.without_repeats(docs.repartition(7)).select("doc_id", F.sha2("kept", 256)).collect()
    assert sorted(whole) == sorted(dealt)
