"""A corpus from documents to packed sequences, stage by stage.

Each stage reads what its predecessor wrote and returns the columns of documents, with its
decision carried out; the last returns packed pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.llm import decontaminate, language, packing, secrets, simhash
from siltworks.llm.frames import table
from siltworks.llm.tokens import word_vocabulary
from siltworks.staging import settle

# A prediction less likely than this is no language.
LEAST_LANGUAGE_SCORE = 0.3


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the classifier tells apart."""
    own = docs.toDF(*(f"_c{i}" for i in range(len(docs.columns))))
    at = {name.lower(): f"_c{i}" for i, name in enumerate(docs.columns)}
    found = language.languages(own, at["text"], at["lang"], at["doc_id"])
    known = (F.col("lang_pred") != language.UNDETERMINED) & (
        F.col("score") >= LEAST_LANGUAGE_SCORE
    )
    return found.filter(known).select(
        *(F.col(f"_c{i}").alias(name) for i, name in enumerate(docs.columns))
    )


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each SimHash group."""
    return simhash.keep_first(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage by the contamination rule."""
    return decontaminate.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked."""
    return secrets.redacted(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their sequence and offset."""
    return packing.pack_documents(docs, word_vocabulary)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", known_language),
    ("near_duplicates", one_of_near_copies),
    ("decontamination", without_benchmark),
    ("secrets", without_secrets),
    ("packing", packed_sequences),
]

# The stages learn a network, hash by functions that DuckDB lacks, and tokenize.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each reading its predecessor's Parquet."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name)
    return docs
