"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept; its result is
written and read again as the next one's docs. All but the last return the columns of docs.
Verdicts hold for rows, whether their doc_id is repeated, null or neither; of near copies one row
stays. Packing takes rows without a doc_id as documents of their own. Texts are judged whole, equal
rows alike, but for the near copies; other columns stay, whatever their names. Empty tables pass
through empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rastro.llm import decontamination, language, ngram_join, packing, quality
from rastro.llm.common import pinned, reachable, read
from rastro.llm.queries import vocabulary

#: Fits and graph searches have no SQL; tests/llm hold the stages against plain versions.
ORACLE_SQL = None


def recognise_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without letters and texts far from every language's centroids."""
    reachable(spark)
    return language.recognised(docs)


def accept_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts that compress like those labelled bad."""
    reachable(spark)
    return quality.accepted(docs, read(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row with the smallest id of each group of near copies."""
    reachable(spark)
    return ngram_join.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold benchmark passages."""
    reachable(spark)
    return decontamination.decontaminated(docs, read(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each piece of a document, with its sequence and place."""
    reachable(spark)
    return packing.pack(docs, vocabulary()).drop("row")


STAGES = [
    ("language ID", recognise_language),
    ("quality classifier", accept_quality),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("best-fit packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, from the table documents."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = pinned(stage(spark, docs, sf_dir))
    return docs
