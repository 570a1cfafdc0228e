import pytest

from rastro.llm.common import reachable

# Names that the operators use inside; a table may have them, too.
CLASHING = ("score", "n", "row", "held_out", "token", "a", "v", "component_id", "rank", "length", "_gone", "size", "_row_number")


@pytest.fixture(autouse=True)
def workers_find_the_package(spark):
    reachable(spark)


@pytest.fixture(scope="session")
def table(spark):
    """A table of documents with columns of clashing names."""

    def make(rows, lang=None):
        schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
            f"`{c}` string" for c in CLASHING
        )
        return spark.createDataFrame(
            [(i, t, (lang or {}).get(i), "s", len(t or ""), *("x",) * len(CLASHING)) for i, t in rows], schema
        )

    return make


LONG = "word number one of a very long text, and some more of it. " * 20_000


@pytest.fixture(scope="session")
def odd_rows():
    """Null, empty, blank, letterless, tiny, repeated and very long texts, and a null id."""
    return [
        (0, "One two three four five six seven eight nine ten."),
        (1, "One two three four five six seven eight nine ten."),
        (1, "One two three four five six seven eight nine ten."),
        (2, None),
        (3, ""),
        (4, " \n\t "),
        (5, "12 345 !!"),
        (6, "É"),
        (7, LONG),
        (None, "a text without an id"),
        (None, None),
    ]


@pytest.fixture(scope="session")
def sample(spark):
    return lambda name: spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")
