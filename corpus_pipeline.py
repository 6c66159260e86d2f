"""A corpus pipeline over ``documents``: classify, de-duplicate, mix, pack.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's ``docs``.

In every stage a null text is empty, null ids and other nulls are values like any
other, an empty table gives an empty one, and further columns of any name are
carried along unchanged (the last stage returns its own). Texts are read whole.
Repeated rows: scored alike by the classifier; one of equal texts, and one of near
copies, stays; those the mix takes stand in for each other; each is packed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from basketry.llm import exact_dedup as exact
from basketry.llm import mixing, ngram_join, packing, quality
from basketry.llm.common import shared_folder, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier takes for low quality go."""
    return quality.good_documents(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays: the one with the smallest id."""
    return exact.drop_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest id."""
    return ngram_join.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target proportions; a document can be taken several times or not at all."""
    return mixing.mixed_documents(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed token windows."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_dedup),
    ("n-gram Jaccard join", near_dedup),
    ("mixing sources", mix_sources),
    ("packing", pack_windows),
]

# classifier training, near-duplicate components and packing are not SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    root = shared_folder(spark, "corpus-pipeline")
    for i, (_, stage) in enumerate(STAGES):
        out = f"{root}/{i}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
