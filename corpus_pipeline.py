"""From raw documents to packed training sequences.

Each stage takes (session, documents, folder of the tables) and returns a table; `run` writes it to the shared folder and
reads it back as the next stage's documents. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.llm import ngram_join, packing, quality, secrets, toxicity
from tierflow.llm.common import documents, frozen

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the fixed limits or the cascade reject go."""
    return quality.keep_good(docs)


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain, trained on the labelled ones among them, takes for toxic go."""
    return toxicity.drop_toxic(docs, toxicity.trained_chain(docs, documents(spark, sf_dir, "labels")))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays."""
    return ngram_join.keep_one(docs)


def live_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Live credentials are replaced by their kind; widely copied examples stay."""
    masked = secrets.mask_live(docs, F.concat_ws("/", "source", "lang"), F.col("source"))
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences."""
    return packing.packed_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("toxicity", toxic_documents),
    ("n-gram join", near_copies),
    ("secret scan", live_secrets),
    ("best-two-fit packing", packed_sequences),
]

# Logistic models, set joins and a tokenizer are not SQL; tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = frozen(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
