"""Nested bronze records made of the order tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siltworks.operators.rules import at_least
from siltworks.plans.spec import Spec
from siltworks.staging import staged_path

MINIMUM_BUDGET = 100000

SPEC = Spec(
    identifier="Id",
    tags="genres",
    attribute="OriginalLanguage",
    rules=(
        at_least("budget", "Budget", MINIMUM_BUDGET, lambda c: F.lit(MINIMUM_BUDGET).cast("double")),
        at_least("runtime", "RunTime", 0, F.abs, null_repairable=True),
    ),
    bridge_key="moviegenreid",
    bridge_record_id="movieid",
    bridge_tag_id="genreid",
    attribute_key="languageid",
    attribute_name="language",
)

_written: dict[tuple[str, str], tuple[str, StructType]] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One flat record per order, with the distinct tags of its lines as an array."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    parts = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.col("p_size").cast("long").alias("id"),
        F.when(F.col("p_type") == "PROMO", "").otherwise(F.col("p_type")).alias("name"),
    )
    # The set of an order holds each tag once, so it stays as small as the tag
    # dimension however many lines the order has, and map tasks combine theirs first.
    tags = (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("l_orderkey")
        .agg(F.sort_array(F.collect_set(F.struct("id", "name"))).alias("genres"))
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    orders = table(spark, sf_dir, "orders")

    def unless_multiple(of: int, value: F.Column) -> F.Column:
        return F.when(F.col("o_orderkey") % of != 0, value)

    return (
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey"), "left")
        .join(tags, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .select(
            F.col("o_orderkey").alias("Id"),
            unless_multiple(89, F.col("o_totalprice")).alias("Budget"),
            unless_multiple(83, F.floor("c_acctbal").cast("long")).alias("RunTime"),
            unless_multiple(97, F.col("o_orderpriority")).alias("OriginalLanguage"),
            F.col("o_orderdate").alias("CreatedDate"),
            "genres",
        )
    )


def build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New bronze rows; every tenth order comes twice."""
    rows = records(spark, sf_dir).select(F.struct("*").alias("value"))
    copies = F.when(F.col("value.Id") % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0))
    )
    return rows.select("value", F.explode(copies)).select("value", F.lit("new").alias("status"))


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bronze table of a session and data folder, written at its first use."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _written:
        rows, path = build(spark, sf_dir), staged_path(spark, "bronze")
        rows.write.parquet(path)
        _written[key] = path, rows.schema
    path, schema = _written[key]
    return spark.read.schema(schema).parquet(path)
