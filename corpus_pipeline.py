"""Training corpus: five stages over `documents`, each written as Parquet and read again by the next.

Each stage works on all that its predecessor kept. All but the last return the columns of
`documents`; the last returns the pieces in their bins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from countypanel.llm.mixing import mixed_documents
from countypanel.llm.packing import pack
from countypanel.llm.pii import sanitised
from countypanel.llm.queries import packing_items
from countypanel.sources.scratch import scratch_folder, written
from countypanel.llm.texts import without_near_duplicates
from countypanel.llm.toxicity import cut, fit, held_out, scored


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on all labelled ones, does not call toxic.

    It calls toxic what scores from `cut` on, found with a classifier that leaves a fifth of the labelled ones out for that.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    least = cut(docs, labels, held_out(5), fit(docs, labels, ~held_out(5)))
    model = fit(docs, labels, labels["doc_id"].isNotNull())
    return scored(docs, model, "__score").where(F.col("__score") < least).drop("__score")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: words in fives, similarity 0.8 or more."""
    return without_near_duplicates(docs, length=5, percent=80)


def privacy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the terms that give it away out of the texts."""
    return sanitised(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents as the mix draws them from their sources."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces in bins of 2048 words."""
    return pack(packing_items(docs), capacity=2048)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("privacy", privacy),
    ("mixture", mixture),
    ("packing", packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = scratch_folder(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"{folder}/{number}-{name}")
    return docs
