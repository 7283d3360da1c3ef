"""One query per operator of this subpackage, each over a whole table of a data folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.llm import (
    archives,
    decontaminate,
    hard_negatives,
    host_rules,
    language,
    language_model,
    packing,
    prefix_trie,
    quality,
    repeats,
    secrets,
    simhash,
    token_files,
)
from siltworks.llm.frames import table
from siltworks.llm.tokens import word_vocabulary

# The folder of public vocabulary files, a package on driver and executors.
VOCABULARIES = "/opt/tokenizers"

Query = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


@query
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.quality(docs, table(spark, sf_dir, "labels")).drop("text")


@query
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.drop("hit_spans")


@query
def op3_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules.host_rules(table(spark, sf_dir, "documents"))


@query
def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return language.languages(docs).drop("text", "lang")


@query
def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_spans(table(spark, sf_dir, "documents")).drop("secret_spans")


@query
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), word_vocabulary)


@query
def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeated_spans(table(spark, sf_dir, "documents")).drop("spans")


@query
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = simhash.grouped(docs, keep=["doc_id"])
    return found.select("doc_id", simhash.as_hex().alias("fingerprint"), "component_id")


@query
def op9_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archives.archived(table(spark, sf_dir, "pages"))


@query
def op10_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.scored(table(spark, sf_dir, "documents"))


@query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.opened_trie(table(spark, sf_dir, "conversations"))


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return hard_negatives.hard_negatives(rows)


@query
def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_documents(table(spark, sf_dir, "documents"), word_vocabulary)
