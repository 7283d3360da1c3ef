import pytest
from hypothesis import given, settings as hypothesis_settings, strategies as st, HealthCheck
from pyspark.sql import functions as F

from siltworks.operators.keys import dense_key, placed_rows, sparse_key
from siltworks.staging import settle


def numbered(df, key):
    return sorted(tuple(r) for r in df.select(key, *[c for c in df.columns if c != key]).collect())


def check_dense(found, values):
    """Ids are 1..n, in order of the values with nulls first."""
    assert [row[0] for row in found] == list(range(1, len(values) + 1))
    ordered = sorted(values, key=lambda row: [(v is not None, v) for v in row])
    assert [row[1:] for row in found] == ordered


@hypothesis_settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.lists(
        st.tuples(st.one_of(st.none(), st.integers(0, 5)), st.one_of(st.none(), st.sampled_from("abc"))),
        max_size=40,
    ),
    st.booleans(),
)
def test_numbers_follow_the_order(spark, values, replayable):
    df = settle(spark.createDataFrame(values, "a int, b string").repartition(3))
    check_dense(numbered(dense_key(df, "id", ["a", "b"], replayable=replayable), "id"), values)


@pytest.mark.parametrize("replayable", [False, True])
def test_hot_value_and_hot_copies_are_spread(spark, settings, replayable):
    """A third of the rows are copies of one record, another third share one order value."""
    settings(spark__sql__adaptive__coalescePartitions__enabled="false")
    settings(spark__sql__shuffle__partitions="6")
    n = 30_000
    df = settle(
        spark.range(n, numPartitions=6).select(
            F.when(F.col("id") % 3 < 2, 7).otherwise(F.col("id")).alias("a"),
            F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("b"),
        )
    )
    result = dense_key(df, "id", ["a"], replayable=replayable)
    stats = result.agg(F.count_distinct("id"), F.min("id"), F.max("id"), F.count("*")).first()
    assert tuple(stats) == (n, 1, n, n)
    following = F.expr("y.id = x.id + 1 AND y.a < x.a")
    assert result.alias("x").join(result.alias("y"), following).count() == 0
    sizes = [r["count"] for r in placed_rows(df, ["a", "b"]).groupBy("_slice").count().collect()]
    assert len(sizes) == 6
    assert max(sizes) < 2 * n / 6


def test_ids_repeat(spark):
    values = [(i % 4, i) for i in range(500)]
    first = dense_key(spark.createDataFrame(values, "a int, b int"), "id", ["a"])
    second = dense_key(
        spark.createDataFrame(values[::-1], "a int, b int").repartition(7), "id", ["a"]
    )
    assert numbered(first, "id") == numbered(second, "id")


def test_no_task_numbers_all_rows(spark):
    keyed = dense_key(spark.range(50).select(F.col("id").alias("a")), "id", ["a"])
    plan = keyed._jdf.queryExecution().executedPlan().toString()
    assert "row_number" not in plan and keyed.count() == 50


def test_sparse_key_is_unique(spark):
    keyed = sparse_key(spark.range(1000, numPartitions=5), "key")
    assert keyed.columns == ["key", "id"]
    assert keyed.select("key").distinct().count() == 1000
