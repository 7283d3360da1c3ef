from collections import Counter

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from siltworks.functions.text import (
    ADDRESS_MARKS_LITERAL, fixed_width, lowered, plain_address, without_dashes,
)
from siltworks.operators import columns, distinct, filters, rules
from siltworks.plans.people import merged_people
from siltworks.plans.variants import entity_status, single_occurrence

QUICK = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def one(spark, value, expression):
    return spark.createDataFrame([(value,)], "x string").select(expression).first()[0]


def test_text(spark):
    assert one(spark, "No.12 North St #4", plain_address("x")) == "12 th st 4"
    assert one(spark, "No.12 North St #4", plain_address("x", ADDRESS_MARKS_LITERAL)) == "12 north st 4"
    assert one(spark, " ÀB ", lowered("x")) == "àb"
    assert one(spark, " 55-5--1 ", without_dashes("x")) == "5551"
    assert one(spark, None, plain_address("x")) is None
    assert one(spark, "ab", fixed_width(("x", 4), ("x", 3), gap={0: "|"})) == "ab  |ab "


def test_people(spark):
    schema = "first string, last string, email string, phone string, address string"
    first = spark.createDataFrame([("Al", "Bo", "A@X", "5-5", "No.1 Elm #2"), ("Al", "Bo", "a@x", "55", "1 Elm 2")], schema)
    second = spark.createDataFrame([("AL", "BO", "a@x", "55", "#1 elm 2"), ("Cy", "Bo", "c@x", "1", "9 Elm")], schema)
    merged = merged_people(first, second)
    assert merged.columns == ["FirstName", "LastName", "Email", "Phone", "Address"]
    assert rows(merged) == [("al", "bo", "a@x", "55", "1 elm 2"), ("cy", "bo", "c@x", "1", "9 elm")]


@QUICK
@given(st.lists(st.one_of(st.none(), st.floats(-10, 10)), max_size=30), st.integers(-5, 5))
def test_split_and_nulls_make_all(spark, values, threshold):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    below, above = filters.split_at(df, "x", threshold)
    assert rows(below) == sorted([(v,) for v in values if v is not None and v < threshold], key=repr)
    assert rows(above) == sorted([(v,) for v in values if v is not None and v >= threshold], key=repr)


def test_blank_split(spark):
    df = spark.createDataFrame([("",), ("a",), (None,), (" ",)], "x string")
    blank, some = filters.split_blank(df, "x")
    assert (rows(blank), rows(some)) == ([("",)], [(" ",), ("a",)])


def test_columns(spark):
    df = spark.createDataFrame(
        [(1, (2, "s"), [5, 6]), (2, (3, "t"), []), (3, None, None)],
        "id int, value struct<a: int, b: string>, items array<int>",
    )
    assert columns.expand_struct(df, "value").columns == ["value", "a", "b"]
    assert rows(columns.expand_struct(df, "value", keep=False)) == [(2, "s"), (3, "t"), (None, None)]
    assert rows(columns.explode_column(df, "items", "item")) == [(5,), (6,)]
    assert rows(columns.explode_column(df, "items", "item", ["id"])) == [(1, 5), (1, 6)]
    exploded = columns.explode_in_place(df, "items")
    assert exploded.dtypes[2] == ("items", "int") and exploded.count() == 2
    assert columns.drop_columns(df, "items", "absent").columns == ["id", "value"]
    replaced = columns.replace_column(df, "id", F.lit("x"))
    assert replaced.dtypes[0] == ("id", "string")
    added = columns.add_metadata(df, "source")
    assert added.columns == [*df.columns, "datasource", "ingesttime", "status", "ingestdate"]
    assert columns.add_metadata(added, "other", "kept").columns == added.columns
    assert added.filter("datasource = 'source' AND status = 'new' AND ingestdate = to_date(ingesttime)").count() == 3


@QUICK
@given(st.lists(st.one_of(st.none(), st.sampled_from(["a", "b", "c", "d"])), max_size=30))
def test_duplicates_and_singletons(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    counts = Counter(values)
    expected = sorted([(v, n) for v, n in counts.items() if n > 1], key=repr)
    assert rows(distinct.duplicates(df, "x")) == expected
    single = {(v, 1) for v, n in counts.items() if n == 1 and v is not None}
    if None in counts:
        single.add((None, 0))
    assert rows(distinct.singletons(df, "x")) == sorted(single, key=repr)


def test_unions(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x")], "n int, s string")
    b = spark.createDataFrame([("x", 1), ("y", 2)], "s string, n int")
    assert rows(distinct.append_all(a, b)) == [(1, "x"), (1, "x"), (1, "x"), (2, "y")]
    assert rows(distinct.distinct_union(a, b)) == [(1, "x"), (2, "y")]


RULES = (
    rules.at_least("budget", "b", 10, lambda c: F.lit(10).cast("double")),
    rules.at_least("runtime", "r", 0, F.abs, null_repairable=True),
)


def test_rules(spark):
    df = spark.createDataFrame(
        [(1, 20.0, 5, "en"), (2, 5.0, -5, "en"), (3, None, 5, "en"), (4, 20.0, None, "en"), (5, 20.0, 5, None)],
        "id int, b double, r bigint, lang string",
    )
    found = {r.id: r.outcome for r in rules.classify(df, RULES, ["lang"]).collect()}
    assert found == {
        1: rules.CLEAN, 2: rules.REPAIRABLE, 3: rules.UNREPAIRABLE, 4: rules.REPAIRABLE, 5: rules.UNREPAIRABLE,
    }
    can_load = df.filter(rules.loadable(RULES, ["lang"]))
    cannot = df.filter(rules.unrepairable(RULES, ["lang"]))
    assert rows(can_load.select("id")) == [(1,), (2,), (4,)]
    assert rows(cannot.select("id")) == [(3,), (5,)]
    repaired = rules.repair(df, RULES)
    assert repaired.dtypes == df.dtypes
    assert rows(repaired.select("id", "b", "r")) == [
        (1, 20.0, 5), (2, 10.0, 5), (3, None, 5), (4, 20.0, None), (5, 20.0, 5),
    ]


def test_single_occurrence(spark):
    df = spark.createDataFrame(
        [(1, 5, "a"), (1, -1, "b"), (2, 5, "c"), (2, 6, "d"), (None, 5, "e"), (3, -1, "f")],
        "id int, r int, s string",
    )
    healthy = ["r >= 0"]
    assert rows(single_occurrence(df, "id", healthy)) == [(1, 5, "a")]
    assert rows(single_occurrence(df, "id", healthy, unfiltered=True)) == [(1, -1, "b"), (1, 5, "a")]


def test_entity_status(spark):
    df = spark.createDataFrame([("a", "new"), ("", "new"), (None, "new")], "name string, status string")
    marked = entity_status(df, F.col("name") != "", F.col("name") == "")
    assert rows(marked) == [("", "quarantined"), ("a", "loaded"), (None, "new")]
    assert entity_status(df).filter("status = 'loaded'").count() == 3
