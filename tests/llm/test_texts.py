"""Token counts, packing, language and quality."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from rastro.llm import language, packing, quality, token_counts
from rastro.llm.queries import QUERIES, vocabulary


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary())


def ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


TRICKY = [
    "I'll  go\n\n now  'lx it's I'S x''ll  \t\n b",
    "  a",
    " \n",
    "a<|endoftext|>b",
    "hi!!<|endoftext|> x  <|endoftext|>",
    "",
    "=====    ====== \xa0\xa0 é ß 日本語 🎉🎉 x  y",
    "don't we've '' 's'",
    "a  \nb  c",
    "\x1c\x85  　 x²½",
]


def test_every_prefix_has_its_count(tokenizer, sample):
    counter = token_counts.PrefixCounter(vocabulary())
    texts = [r.text for r in sample("documents").limit(25).collect()]
    for text in [*TRICKY, *(t[:250] for t in texts)]:
        counts = np.cumsum(np.frombuffer(counter.table(text), np.int8), dtype=int).tolist()
        assert counts == [len(ids(tokenizer, text[:i])) for i in range(1, len(text) + 1)], text


def test_counts_are_the_tokenizers(spark, sf_dir, tokenizer):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = QUERIES["op8_token_counts"](spark, sf_dir).collect()
    assert len(found) == len(texts)
    for r in found:
        n = len(ids(tokenizer, texts[r.doc_id]))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 512)


def test_questions_about_prefixes(table, tokenizer):
    text = "Antidisestablishmentarianism, isn't it?  Yes 🎉!"
    tables = token_counts.prefix_tables(table([(1, text), (2, None)]), vocabulary())
    asked = tables.select(
        "doc_id",
        token_counts.tokens_at(F.col("prefix"), F.lit(9)).alias("at"),
        token_counts.longest_within(F.col("prefix"), F.lit(4)).alias("fits"),
    )
    counts = [len(ids(tokenizer, text[:i])) for i in range(len(text) + 1)]
    longest = max(i for i, n in enumerate(counts) if n <= 4)
    assert {tuple(r) for r in asked.collect()} == {(1, counts[9], longest), (2, 0, 0)}


def test_token_counts_of_odd_rows(table, odd_rows, tokenizer):
    found = token_counts.prefix_tables(table(odd_rows), vocabulary()).select("doc_id", "n_bytes", "n_tokens")
    want = sorted(
        (i if i is not None else -1, len((t or "").encode()), len(ids(tokenizer, t))) for i, t in odd_rows
    )
    assert sorted((r[0] if r[0] is not None else -1, r[1], r[2]) for r in found.collect()) == want
    assert token_counts.prefix_tables(table([]), vocabulary()).count() == 0


def check_packing(found, docs, tokenizer, capacity=2048):
    """Every id of every document once, sequences without gaps; returns their number."""
    pieces, sequences = {}, {}
    for r in found:
        pieces.setdefault(r.row, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    want = sorted((i if i is not None else -1, tuple([*ids(tokenizer, t), 0])) for i, t in docs)
    got = []
    for rows in pieces.values():
        rows.sort(key=lambda r: r.piece)
        assert [r.piece for r in rows] == list(range(len(rows)))
        assert all(r.length == capacity for r in rows[1:])
        got.append((rows[0].doc_id if rows[0].doc_id is not None else -1, rows))
    assert len(got) == len(want)
    by_id = {}
    for i, tokens in want:
        by_id.setdefault(i, []).append(tokens)
    for i, rows in got:
        sums = [(r.start, r.length, r.ids_crc32) for r in rows]
        fits = []
        for tokens in by_id[i]:
            crc = [
                (s, n, zlib.crc32(np.array(tokens[s : s + n], "<u4").tobytes())) for s, n, _ in sums
            ]
            fits.append(crc == sums and sum(n for _, n, _ in sums) == len(tokens))
        assert any(fits)
    for rows in sequences.values():
        rows.sort(key=lambda r: r.offset)
        at = 0
        for r in rows:
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return len(sequences)


def test_packing_fills_sequences(spark, sample, tokenizer):
    docs = sample("documents")
    found = packing.pack(docs, vocabulary()).collect()
    n = check_packing(found, [(r.doc_id, r.text) for r in docs.collect()], tokenizer)
    assert n <= -(-sum(r.length for r in found) // 2048) + 1


def test_packing_of_odd_rows(table, odd_rows, tokenizer):
    check_packing(packing.pack(table(odd_rows), vocabulary()).collect(), odd_rows, tokenizer)
    assert packing.pack(table([]), vocabulary()).count() == 0


def test_best_fit_equals_one_by_one():
    """Runs of equal lengths are placed as best-fit decreasing places single documents."""
    random = np.random.default_rng(5)
    for _ in range(30):
        lengths = random.integers(1, 65, random.integers(1, 400)).tolist()
        counts = {n: lengths.count(n) for n in set(lengths)}
        gaps = []
        for n in sorted(lengths, reverse=True):
            fit = min((g for g in gaps if g >= n), default=None)
            if fit is None:
                gaps.append(64 - n)
            else:
                gaps[gaps.index(fit)] = fit - n
        places, used = packing.best_fit(counts, 64), {}
        for length, low, high, each, sequence, offset in places:
            for k in range(high - low):
                at = offset + k % each * length
                used.setdefault(sequence + k // each, []).append((at, length))
        for spans in used.values():
            at = 0
            for start, length in sorted(spans):
                assert start == at
                at += length
            assert at <= 64
        assert len(used) == len(gaps)


def test_languages_are_told_apart(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lang = {r.doc_id: r.lang for r in docs.collect()}
    found = [r for r in language.identify(docs).collect()]
    assert len(found) == len(lang)
    assert all((zlib.crc32(str(r.doc_id).encode()) % 3 == 1) == r.held_out for r in found)
    assert all(0 <= r.score <= 1 for r in found)
    held = [r for r in found if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)
    assert not any(r.rejected for r in found)


def test_foreign_text_is_rejected(spark, table):
    model = language.learned(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    rows = [(1, "Съешь же ещё этих мягких французских булок, да выпей чаю. " * 4), (2, "of the and that is on " * 9)]
    found = {r.doc_id: r for r in language.identify(table(rows), model).collect()}
    assert found[1].rejected and not found[2].rejected and found[2].lang_pred == "en"


def test_language_vectors_do_not_depend_on_neighbours():
    texts = ["Ünter den", "", "Ça va?", "x"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    places = np.cumsum([0, *(len(t.encode()) for t in texts)])
    together = language.counts(data, places)
    for i, t in enumerate(texts):
        one = np.frombuffer(t.encode(), np.uint8)
        assert (language.counts(one, np.array([0, len(one)])) == together[i]).all()


def test_languages_of_odd_rows(table, odd_rows):
    lang = {0: "en", 1: "en", 6: "fr", 7: None}
    found = language.identify(table(odd_rows, lang)).collect()
    assert len(found) == len(odd_rows)
    for r in found:
        if r.doc_id in (2, 3, 4, 5):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
        elif r.doc_id is not None:
            assert r.lang_pred in ("en", "fr")
    kept = language.recognised(table(odd_rows, lang))
    assert kept.columns == table(odd_rows).columns
    stay = sorted(r.doc_id for r in found if r.doc_id is not None and not r.rejected)
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == stay
    assert stay[:4] == [0, 1, 1, 6]
    assert language.identify(table([])).count() == 0
    # Nothing to learn from.
    assert {r.lang_pred for r in language.identify(table(odd_rows)).collect()} == {"und"}


def test_quality_of_held_out_text(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    found = quality.quality(docs, labels)
    judged = found.join(labels, "doc_id").filter("held_out").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in judged)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in judged)
    good = [r for r in judged if r.quality == 1]
    bad = [r for r in judged if r.quality == 0]
    assert sum(r.predicted for r in good) >= 0.98 * len(good)
    assert sum(r.predicted for r in bad) <= 0.15 * len(bad)


def test_quality_does_not_look_at_held_out_labels(spark, sample):
    docs, labels = sample("documents"), sample("labels")
    other = labels.withColumn(
        "quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, 0).otherwise(F.col("quality"))
    )
    first, second = (
        {r.doc_id: r.score for r in quality.quality(docs, x).collect()} for x in (labels, other)
    )
    assert first == second


def test_quality_of_odd_rows(spark, table, odd_rows):
    labels = spark.createDataFrame(
        [(0, 1, 0), (1, None, 1), (3, 0, 0), (7, 5, 0), (None, 1, 1)], "doc_id long, quality int, toxic int"
    )
    found = quality.quality(table(odd_rows), labels).collect()
    assert len(found) == len(odd_rows) and all(0 <= r.score <= 1 for r in found)
    none = quality.quality(table(odd_rows), labels.filter("false")).collect()
    assert {r.score for r in none} == {0.5}
    assert quality.quality(table([]), labels).count() == 0
    assert quality.accepted(table([]), labels).columns == table([]).columns
