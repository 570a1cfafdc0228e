"""The stages, each against a plain version on its own input."""

import pytest

import corpus_pipeline
from rastro.llm import language, quality
from rastro.llm.common import pinned
from test_matches import brute_components, brute_hits
from test_texts import check_packing, tokenizer  # noqa: F401


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_stages_do_what_they_say(spark, sf_dir, tokenizer):  # noqa: F811
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    docs = read("documents")
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language ID",
        "quality classifier",
        "n-gram Jaccard join",
        "benchmark decontamination",
        "best-fit packing",
    ]

    def kept(name, docs):
        out = pinned(stages[name](spark, docs, sf_dir))
        assert out.columns == columns
        return out

    first = kept("language ID", docs)
    assert ids(first) == ids(language.identify(docs).filter("NOT rejected"))
    second = kept("quality classifier", first)
    assert ids(second) == ids(quality.quality(first, read("labels")).filter("predicted = 1"))
    third = kept("n-gram Jaccard join", second)
    rows = [(r.doc_id, r.text) for r in second.collect()]
    assert ids(third) == [i for i, _, c in brute_components(rows) if i == c]
    fourth = kept("benchmark decontamination", third)
    rows = [(r.doc_id, r.text) for r in third.collect()]
    items = [(r.item_id, r.text) for r in read("benchmark").collect()]
    assert ids(fourth) == [r[0] for r in brute_hits(rows, items) if not r[4]]
    assert 0 < fourth.count() < third.count() < second.count() < first.count() <= docs.count()
    last = corpus_pipeline.run(spark, sf_dir)
    assert {r.doc_id for r in last.collect()} == set(ids(fourth))
    assert corpus_pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_keep_columns_and_survive_odd_rows(spark, sf_dir, table, odd_rows, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    rows = table(odd_rows, {0: "en", 1: "en"})
    out = stage(spark, rows, sf_dir)
    assert out.schema == rows.schema
    # Language ID rejects the null text, with an id or without.
    assert sum(r.doc_id is None for r in out.collect()) == (1 if name == "language ID" else 2)
    empty = stage(spark, table([]), sf_dir)
    assert empty.columns == rows.columns and empty.count() == 0


def test_verdicts_hold_for_rows_and_not_for_ids(spark, sf_dir, table):
    """Repeated ids: of a table ingested twice one row of each group stays, and a rejected row
    takes none with it that has its id."""
    stages = dict(corpus_pipeline.STAGES)
    item = next(r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect() if len(r.text.split()) > 15)
    plain = "Some quiet words that no list of questions has ever held, in one row."
    rows = [(1, plain), (1, plain), (2, plain), (3, item), (3, "Another text with the same number."), (None, item)]
    rows += [(None, plain), (4, "12 345 !!"), (4, plain + " It goes on for a while, with other words.")]
    out = lambda name: sorted(
        ((r.doc_id, r.text) for r in stages[name](spark, table(rows, {1: "en", 2: "en"}), sf_dir).collect()), key=str
    )
    assert out("n-gram Jaccard join") == sorted([rows[0], rows[3], rows[4], rows[7], rows[8]], key=str)
    assert out("benchmark decontamination") == sorted([r for r in rows if r[1] != item], key=str)
    # The passage is far from the language learned, with an id or without.
    gone = ((3, item), (None, item), (4, "12 345 !!"))
    assert out("language ID") == sorted([r for r in rows if r not in gone], key=str)
