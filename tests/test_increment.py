"""Refresh by load against one refresh of everything."""

from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F

from siltworks.plans import increment, refine
from siltworks.plans.spec import MOVIE_SCHEMA, movie_spec
from siltworks.sources.snapshots import current_snapshot, partition_locations
from siltworks.staging import settle, staged_path
from tests.test_refine import ACTION, DRAMA, MOVIES

LOADS = [
    [*MOVIES, (20, None, 5, "it", DRAMA)],
    # Copies of healthy, repairable and stuck records, alone and repeated before; new attributes and tags.
    [(1, 2e6, 100, "en", ACTION), (6, None, 60, "en", ACTION), (20, None, 5, "it", DRAMA), (9, None, 30, "en", ACTION),
     (21, 3e6, 7, "aa", [{"id": 9, "name": "Noir"}]), (2, 5e5, 90, "en", []), (22, None, 1, "en", ACTION), (7, 2e6, 50, None, ACTION)],
    [],
    [(22, None, 1, "en", ACTION), (23, 1.0, -5, "de", DRAMA), (21, 3e6, 7, "aa", ACTION), (24, None, 2, None, None)],
]
FIELDS = ("Id", "Budget", "RunTime", "OriginalLanguage", "genres")


def documents(spark, movies):
    record = "struct<Id: bigint, Budget: double, RunTime: bigint, OriginalLanguage: string, genres: array<struct<id: bigint, name: string>>>"
    rows = [([dict(zip(FIELDS, movie)) for movie in movies],)]
    return spark.createDataFrame(rows, f"movie array<{record}>")


def multiset(df, *names):
    return Counter(tuple(row) for row in df.select(*names).collect()) if df is not None else Counter()


def named_silver(silver, attributes):
    return silver.join(attributes, F.col("OriginalLanguage") == F.col("languageid")).withColumn("OriginalLanguage", F.col("language"))


def assert_equals_one_refresh(spark, layers, movies):
    spec = layers.spec
    bronze = settle(refine.bronze_rows(documents(spark, movies), "movie", spec, "x"))
    attributes = settle(refine.attribute_dimension(bronze, spec))
    status = refine.final_status(bronze, spec)
    assert multiset(layers.read("bronze"), "value.Id", "value.Budget", "status") == multiset(status, "value.Id", "value.Budget", "status")
    silver = named_silver(refine.silver(bronze, attributes, spec), attributes)
    found = named_silver(layers.read("silver"), layers.read("attribute"))
    names = FIELDS[:4]
    assert multiset(found, *names) == multiset(silver, *names)
    assert multiset(layers.read("tag"), "id", "name") == multiset(refine.tag_dimension(bronze, spec), "id", "name")
    assert multiset(layers.read("attribute"), "language") == multiset(attributes, "language")
    pairs = refine.bridge(bronze, spec)
    assert multiset(layers.read("bridge"), "movieid", "genreid") == multiset(pairs, "movieid", "genreid")
    keys = [row[0] for row in layers.read("bridge").select("moviegenreid").collect()]
    assert sorted(keys) == list(range(1, len(keys) + 1))


@pytest.fixture
def layers(spark, database):
    return increment.Layers(spark, staged_path(spark, "layers"), database, movie_spec(), buckets=4)


def run(layers, number):
    day = date(2024, 1, 1 + number // 2)
    return layers.run(documents(layers.spark, LOADS[number]), f"load {number}", "movie", "x", day)


def test_loads(spark, layers):
    keys = {}
    for number in range(len(LOADS)):
        before = partition_locations(spark, current_snapshot(spark, layers.tables["bronze"])) if number else {}
        assert run(layers, number)
        now = {r["language"]: r["languageid"] for r in layers.read("attribute").collect()}
        assert keys.items() <= now.items()
        keys = now
        after = partition_locations(spark, current_snapshot(spark, layers.tables["bronze"]))
        moved = {dict(spec)["load"] for spec in before if before[spec] != after[spec]}
        # Movies 6 and 20 stood alone in the first load, and 22 in the second.
        assert moved == {1: {"load 0"}, 3: {"load 1"}}.get(number, set())
        if number == 1:
            assert_equals_one_refresh(spark, layers, [m for load in LOADS[:2] for m in load])
    # A finished load changes nothing, whatever it brings.
    assert not layers.run(documents(spark, MOVIES), "load 1", "movie", "x")
    assert layers.finished() == {f"load {i}" for i in range(4)}
    assert_equals_one_refresh(spark, layers, [m for load in LOADS for m in load])


@pytest.mark.parametrize("step", ["_dimensions", "_silver"])
def test_load_that_broke_off(spark, layers, monkeypatch, step):
    """A load stopped before any of its later steps is run again as a whole."""
    run(layers, 0)
    with monkeypatch.context() as broken:
        broken.setattr(increment.Layers, step, lambda *args: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run(layers, 1)
    assert layers.finished() == {"load 0"}
    assert run(layers, 1)
    assert_equals_one_refresh(spark, layers, [*LOADS[0], *LOADS[1]])


def test_new_rows_are_read_alone(spark, layers):
    run(layers, 0)
    run(layers, 1)
    plan = layers.part("bronze", "load 1")._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "PartitionFilters" in line)
    assert "(load#" in scan and "= load 1)" in scan
    assert layers.part("bronze", "load 1").count() == len(LOADS[1])


def test_schema_is_the_documents(spark, layers):
    """Whole movie records too."""
    empty = spark.createDataFrame([], MOVIE_SCHEMA)
    assert layers.run(empty, "nothing", "movie", "x")
    assert layers.read("bronze").count() == 0 and layers.read("silver").count() == 0
