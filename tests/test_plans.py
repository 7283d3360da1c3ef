"""The shape of physical plans: what is shuffled, broadcast, pushed down and read."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from siltworks.operators import distinct, joins, status
from siltworks.plans import refine
from siltworks.staging import settle
from workload.bronze import SPEC, bronze, table

SF_DIR = "/root/testdata/sf0.001"


def initial_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    """The plan as adaptive execution left it."""
    rows = df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return rows, plan.split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def records(spark):
    return bronze(spark, SF_DIR)


def test_dimension_reads_only_tags(records):
    plan = initial_plan(refine.tag_dimension(records, SPEC))
    assert set(re.findall(r"ReadSchema: (\S+)", plan)) == {
        "struct<value:struct<genres:array<struct<id:bigint,name:string>>>>"
    }
    assert plan.count("Exchange") == 1


def test_attribute_reads_one_field(records):
    plan = initial_plan(records.select("value.OriginalLanguage").distinct())
    assert "ReadSchema: struct<value:struct<OriginalLanguage:string>>" in plan


def test_silver_pushes_null_tests_and_shuffles_only_for_distinct(records):
    languages = settle(refine.attribute_dimension(records, SPEC))
    # What silver reads twice: once for the hashes, once to write repeated rows apart.
    plan = initial_plan(refine.loadable(records, languages, SPEC))
    assert "IsNotNull(value.Budget)" in plan and "IsNotNull(value.OriginalLanguage)" in plan
    assert "BroadcastHashJoin" in plan
    assert "Exchange hashpartitioning" not in plan
    scanned = re.findall(r"ReadSchema: (\S+)", plan)[0]
    assert "genres" not in scanned
    plan = initial_plan(refine.silver(records, languages, SPEC))
    assert plan.count("Exchange hashpartitioning") == 1


def test_status_shuffles_no_loadable_record(records):
    plan = initial_plan(refine.final_status(records, SPEC))
    assert "Exchange hashpartitioning" not in plan
    assert "Exchange SinglePartition" not in plan
    assert "BroadcastHashJoin" in plan


def test_membership_broadcasts_small_keys_only(spark, settings):
    orders, lines = table(spark, SF_DIR, "orders"), table(spark, SF_DIR, "lineitem")
    small = joins.is_in(orders, "o_orderkey", lines, "l_orderkey")
    assert "BroadcastHashJoin" in initial_plan(small)
    settings(spark__sql__autoBroadcastJoinThreshold="100")
    large = joins.not_in(orders, "o_orderkey", lines, "l_orderkey")
    assert "SortMergeJoin" in initial_plan(large)
    assert large.count() == orders.count() - lines.select("l_orderkey").distinct().count()


@pytest.fixture
def hot_join(settings):
    """Settings under which a few thousand rows count as large and skewed."""
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
        spark__sql__shuffle__partitions="16",
    )


@pytest.fixture
def hot_rows(spark):
    """A third of 60,000 rows have one key; half of the keys are wanted."""
    hot = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id"))
    return settle(
        spark.range(60_000, numPartitions=8).select(
            F.struct(hot.alias("k")).alias("value"), F.lit("new").alias("status"), "id"
        )
    )


def test_hot_keys_are_split(spark, hot_join, hot_rows):
    keys = hot_rows.filter("value.k < 30000").select("value")
    expected = hot_rows.filter("value.k < 30000").count()
    flat = hot_rows.select("value.k", "id")
    wanted = keys.select("value.k")
    natural = wanted.distinct().withColumnRenamed("k", "natural")
    dimension = settle(natural.withColumn("key", F.col("natural") + 1))
    results = {
        "status": status.apply_status(hot_rows, keys, "loaded").filter("status = 'loaded'"),
        "in": joins.is_in(flat, "k", wanted),
        "replace": joins.replace_with_key(flat, "k", dimension, "natural", "key"),
    }
    for name, df in results.items():
        rows, plan = final_plan(df)
        assert len(rows) == expected, name
        assert "isSkew=true" in plan or "skew=true" in plan, name


def test_hot_unrepairable_record_is_split(spark, hot_join):
    """A third of the rows are copies of one record that cannot be repaired."""
    hot = F.col("id") % 3 == 0
    rows = settle(
        spark.range(60_000, numPartitions=8).select(
            F.struct(
                F.when(hot, 7).otherwise(F.col("id")).alias("Id"),
                F.lit(None).cast("double").alias("Budget"),
                F.lit(1).cast("long").alias("RunTime"),
                F.lit("en").alias("OriginalLanguage"),
                F.array(F.struct(F.lit(1).cast("long").alias("id"), F.lit("a").alias("name"))).alias("genres"),
            ).alias("value"),
            F.sha1(F.col("id").cast("string")).alias("datasource"),
            F.lit("new").alias("status"),
        )
    )
    found, plan = final_plan(refine.final_status(rows, SPEC))
    assert Counter(r.status for r in found) == {"loaded": 20_001, "quarantined": 39_999}
    assert "skew=true" in plan.lower()


def test_copies_collapse_before_the_shuffle(spark, hot_rows):
    plan = initial_plan(distinct.duplicates(hot_rows.select("value"), "value"))
    assert plan.index("partial_count") > plan.index("Exchange hashpartitioning")
    assert distinct.duplicates(hot_rows, "value").first().copies == 20_001


def test_narrow_duplicates_shuffle_hashes_only(spark):
    documents = table(spark, SF_DIR, "documents")
    plan = initial_plan(distinct.duplicates(documents, "text"))
    assert "BroadcastHashJoin [_row_key" in plan


def test_unique_records_are_not_shuffled(spark, records):
    """Only rows whose hash repeats reach the exchange of a distinct."""
    rows, plan = final_plan(distinct.distinct_records(records.select("value")))
    assert len(rows) == records.select("value").distinct().count() == 1500
    single, some = plan.split("Union")[1].split("HashAggregate", 1)
    assert "PartitionFilters: [isnotnull(_again" in single and "NOT _again" in single
    assert "Exchange" not in single
    assert "Exchange hashpartitioning" in some


def test_hot_record_is_spread(spark, hot_join, hot_rows):
    rows, _ = final_plan(distinct.distinct_records(hot_rows.select("value")))
    assert len(rows) == 40_000 == len(set(rows))


def test_compressible_members_are_not_broadcast(spark, settings):
    """Membership sets are measured by their values, not by their compressed files."""
    settings(spark__sql__autoBroadcastJoinThreshold="1MB")
    records = settle(
        spark.range(300).selectExpr(
            "named_struct('id', id, 'text', repeat('x', 20000)) AS value", "'new' AS status"
        )
    )
    marked = status.apply_status(records, records.select("value"), "loaded")
    assert "SortMergeJoin" in initial_plan(marked) and "BroadcastHashJoin" not in initial_plan(marked)
    assert marked.filter("status = 'loaded'").count() == 300
