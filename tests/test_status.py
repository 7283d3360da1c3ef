"""Status updates against row-level SQL, with its null rules."""

import itertools

import duckdb
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from siltworks.operators.joins import is_in, join_using, not_in, replace_with_key
from siltworks.operators.status import apply_status, merge_status, quarantined
from siltworks.staging import settle

SCHEMA = "value struct<a: int, t: array<struct<id: bigint, name: string>>, d: double>, status string"

RECORDS = [
    {"a": 1, "t": [(1, "x"), (2, None)], "d": 0.0},
    {"a": 1, "t": [(1, "x"), (2, None)], "d": 0.0},
    {"a": 1, "t": [(1, "x")], "d": 0.0},
    {"a": None, "t": None, "d": None},
    {"a": 2, "t": [], "d": None},
    None,
]


def frame(spark, records):
    return spark.createDataFrame([(r, "new") for r in records], SCHEMA)


KEY_SETS = {
    "one": RECORDS[:1],
    "all_null_fields": [RECORDS[3]],
    "several": [RECORDS[0], RECORDS[0], RECORDS[4]],
    "with_null": [RECORDS[2], None],
    "only_null": [None],
    "empty": [],
}


def sql_in(value, keys):
    """SQL's three-valued IN, where nulls inside a record are equal to each other."""
    if not keys:
        return False
    if value is None:
        return None
    if any(value == key for key in keys):
        return True
    return None if None in keys else False


@pytest.mark.parametrize("negate", [False, True])
@pytest.mark.parametrize("name", KEY_SETS)
def test_apply_status(spark, name, negate):
    keys = KEY_SETS[name]
    result = apply_status(frame(spark, RECORDS), frame(spark, keys), "loaded", negate=negate)
    assert result.columns == ["value", "status"]
    expected = []
    for record in RECORDS:
        member = sql_in(record, keys)
        chosen = (not member if member is not None else None) if negate else member
        expected.append("loaded" if chosen else "new")
    assert sorted(r.status for r in result.collect()) == sorted(expected)
    again = apply_status(result, frame(spark, keys), "loaded", negate=negate)
    assert sorted(map(repr, again.collect())) == sorted(map(repr, result.collect()))


def test_negative_zero_is_zero(spark):
    rows = frame(spark, [{"a": 1, "t": [], "d": -0.0}])
    keys = frame(spark, [{"a": 1, "t": [], "d": 0.0}])
    assert apply_status(rows, keys, "loaded").first().status == "loaded"


@pytest.mark.parametrize(
    "values, keys",
    list(itertools.product([[1, 2, 2, None], [None], []], [[2, 2, 3], [2, None], [None], []])),
)
def test_membership_filters(spark, values, keys):
    connection = duckdb.connect()
    for name, numbers in (("v", values), ("k", keys)):
        connection.execute(f"CREATE TABLE {name} (x INTEGER)")
        for number in numbers:
            connection.execute(f"INSERT INTO {name} VALUES (?)", [number])
    left = spark.createDataFrame([(v,) for v in values], "x int")
    right = spark.createDataFrame([(k,) for k in keys], "x int")
    for operator, test in ((is_in, "IN"), (not_in, "NOT IN")):
        expected = connection.execute(f"SELECT x FROM v WHERE x {test} (SELECT x FROM k)").fetchall()
        found = [tuple(r) for r in operator(left, "x", right).collect()]
        assert sorted(found, key=repr) == sorted(expected, key=repr), test


def test_merge(spark):
    rows = spark.createDataFrame(
        [(1, "new"), (1, "new"), (2, "new"), (3, "new"), (None, "new")], "id int, status string"
    )
    updates = spark.createDataFrame(
        [(1, "loaded"), (1, "loaded"), (2, None), (None, "loaded"), (9, "a"), (9, "b")],
        "id int, status string",
    )
    found = sorted(map(tuple, merge_status(rows, updates, "id").collect()), key=repr)
    assert found == sorted(
        [(1, "loaded"), (1, "loaded"), (2, None), (3, "new"), (None, "new")], key=repr
    )


def test_merge_fails_where_matching_updates_disagree(spark):
    rows = spark.createDataFrame([(1, "new")], "id int, status string")
    updates = spark.createDataFrame([(1, "loaded"), (1, "quarantined")], "id int, status string")
    with pytest.raises(PySparkException, match="disagree"):
        merge_status(rows, updates, "id").collect()


def test_quarantined_expands_the_record(spark):
    rows = frame(spark, RECORDS[:2]).withColumn("status", F.lit("quarantined"))
    assert quarantined(rows).columns == ["value", "a", "t", "d"]
    assert quarantined(frame(spark, RECORDS)).count() == 0


def test_replace_with_key(spark):
    rows = spark.createDataFrame([(1, "en", 5), (2, None, 5), (3, "xx", 5)], "id int, lang string, z int")
    languages = settle(spark.createDataFrame([(1, None), (2, "en")], "languageid bigint, language string"))
    found = replace_with_key(rows, "lang", languages, "language", "languageid", drop=["z", "absent"])
    assert found.dtypes == [("id", "int"), ("lang", "bigint")]
    assert [tuple(r) for r in found.collect()] == [(1, 2)]


@pytest.mark.parametrize("size", [20, 5000])
def test_dimensions_are_sized_by_their_values(spark, size):
    """A dimension that compresses to nothing is broadcast only while its values are small."""
    names = spark.range(4000).select(
        F.concat(F.repeat(F.lit("x"), size), F.col("id").cast("string")).alias("name"), "id"
    )
    dimension = settle(names)
    df = settle(names.withColumnRenamed("name", "value"), plain=True)
    small = size * 4000 < 10 << 20
    for joined in (
        replace_with_key(df.select("value"), "value", dimension, "name", "id"),
        join_using(df.drop("id").withColumnRenamed("value", "name"), dimension, "name"),
    ):
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert ("BroadcastHashJoin" in plan) == small and ("SortMergeJoin" in plan) != small
        assert joined.count() == 4000
