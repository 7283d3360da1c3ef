"""The whole refinement: twelve hand-made edge cases, and known counts of derived records."""

import json
import threading
from pathlib import Path

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from siltworks.operators.distinct import duplicates
from siltworks.plans import checks, refine
from siltworks.plans.spec import MOVIE_ARRAY, MOVIE_DATASOURCE, MOVIE_FILES, MOVIE_SCHEMA, movie_spec
from siltworks.sources.tables import read_table
from siltworks.staging import settle
from workload import stepwise
from workload.bronze import SPEC, bronze

ACTION = [{"id": 1, "name": "Action"}]
BLANK = {"id": 2, "name": ""}
DRAMA = [{"id": 3, "name": "Drama"}]

# Id, Budget, RunTime, OriginalLanguage, genres
MOVIES = [
    (1, 2e6, 100, "en", ACTION),
    (2, 5e5, 90, "en", [*ACTION, BLANK]),
    (3, 3e6, -80, "fr", ACTION),
    (4, 1e5, -70, "fr", ACTION),
    (5, 2e6, None, "en", ACTION),
    (6, None, 60, "en", ACTION),
    (7, 2e6, 50, None, ACTION),
    (8, 2e6, 40, "en", DRAMA),
    (8, 2e6, 40, "en", DRAMA),
    (9, None, 30, "en", ACTION),
    (9, None, 30, "en", ACTION),
    (10, 1e6, 0, "en", []),
]


def _write(path, movies):
    names = ("Id", "Budget", "RunTime", "OriginalLanguage", "genres")
    path.write_text(json.dumps({"movie": [dict(zip(names, movie)) for movie in movies]}, indent=1))


@pytest.fixture(scope="module")
def spec():
    return movie_spec()


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory, spec):
    landing = tmp_path_factory.mktemp("landing")
    _write(landing / "movie_0.json", MOVIES[:6])
    _write(landing / "movie_1.json", MOVIES[6:])
    _write(landing / "Movie_2.json", [(99, 2e6, 1, "xx", ACTION)])
    (landing / "notes.txt").write_text("not a movie")
    (landing / "movie_broken.json").write_text('{"movie": [')
    root = str(tmp_path_factory.mktemp("layers"))
    (landing / "day=1").mkdir()
    _write(landing / "day=1" / "movie_9.json", [(98, 2e6, 1, "xx", ACTION)])
    args = (spark, str(landing), root, "edge_cases", spec, MOVIE_SCHEMA, MOVIE_ARRAY, MOVIE_DATASOURCE)
    for _ in range(3):  # a full refresh: each run replaces the one before
        tables = refine.refine(*args, name_glob=MOVIE_FILES)
    for name in spec.tables.values():
        assert len(list((Path(root) / name).glob("snapshot-*"))) == 2
    yield {role: read_table(spark, name) for role, name in tables.items()}
    spark.catalog.setCurrentDatabase("default")


def rows(df, *names):
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


def test_attribute_dimension(loaded):
    assert rows(loaded["attribute"], "languageid", "language") == [(1, None), (2, "en"), (3, "fr")]


def test_tag_dimension(loaded):
    assert rows(loaded["tag"], "id", "name") == [(1, "Action"), (3, "Drama")]


def test_bridge(loaded):
    pairs = [(1, 1), (2, 1), (2, 2), (3, 1), (4, 1), (5, 1), (6, 1), (7, 1), (8, 3), (8, 3), (9, 1), (9, 1)]
    found = loaded["bridge"].orderBy("moviegenreid").collect()
    assert [r.moviegenreid for r in found] == list(range(1, 13))
    assert [(r.movieid, r.genreid) for r in found] == pairs
    assert loaded["bridge"].columns == ["moviegenreid", "movieid", "genreid"]


def test_silver(loaded):
    expected = [
        (1, 2e6, 100, 2), (2, 1e6, 90, 2), (3, 3e6, 80, 3), (4, 1e6, 70, 3),
        (5, 2e6, None, 2), (8, 2e6, 40, 2), (10, 1e6, 0, 2),
    ]
    assert rows(loaded["silver"], "Id", "Budget", "RunTime", "OriginalLanguage") == sorted(expected, key=repr)
    names = [line.split(":")[0].strip() for line in MOVIE_SCHEMA.splitlines()[2:-2]]
    assert loaded["silver"].columns == names


def test_bronze(loaded):
    bronze_table = loaded["bronze"]
    assert set(bronze_table.columns) == {"value", "datasource", "ingesttime", "status", "ingestdate"}
    assert dict(bronze_table.dtypes)["ingestdate"] == "date"
    assert rows(bronze_table.filter("status <> 'loaded'"), "value.Id", "status") == [
        (6, "quarantined"), (7, "quarantined"),
    ]
    assert rows(bronze_table.filter("value.Id = 9"), "status") == [("loaded",), ("loaded",)]
    assert bronze_table.count() == 12


def test_end_state(loaded, spec):
    frames = [loaded[role] for role in ("bronze", "silver", "tag")]
    counts = checks.end_state(*frames, spec, loaded["unreadable"])
    assert dict(rows(counts, "check", "rows")) == {
        "silver_rows": 7, "budget_failing": 0, "runtime_failing": 0, "budget_null": 0,
        "runtime_null": 1, "bronze_rows": 12, "not_loaded": 2, "null_unclassified": 4,
        "missing_attribute": 1,
        "tag_rows": 2, "blank_tag_name": 0, "unreadable_documents": 1,
    }
    assert rows(checks.violations(counts, spec), "check", "rows") == [
        ("not_loaded", 2), ("unreadable_documents", 1),
    ]
    assert checks.end_state(*frames, spec).count() == 11
    (lost,) = loaded["unreadable"].collect()
    assert lost.path.endswith("/movie_broken.json") and lost.text == '{"movie": ['


def test_strict_load_fails(spark, tmp_path, spec):
    (tmp_path / "movie_broken.json").write_text('{"movie": [')
    with pytest.raises((PySparkException, Py4JJavaError)):
        refine.refine(
            spark, str(tmp_path), str(tmp_path / "out"), "strict_load", spec, MOVIE_SCHEMA,
            MOVIE_ARRAY, MOVIE_DATASOURCE, name_glob=MOVIE_FILES, mode="FAILFAST",
        )
    spark.catalog.setCurrentDatabase("default")


def test_nothing_has_landed(spark, tmp_path, spec):
    (tmp_path / "land").mkdir()
    (tmp_path / "land" / "notes.txt").write_text("not a movie")
    tables = refine.refine(
        spark, str(tmp_path / "land"), str(tmp_path / "out"), "no_landing", spec, MOVIE_SCHEMA,
        MOVIE_ARRAY, MOVIE_DATASOURCE, name_glob=MOVIE_FILES,
    )
    assert len(tables) == 6
    for name in tables.values():
        assert read_table(spark, name).count() == 0
    assert "value" in read_table(spark, tables["bronze"]).columns
    spark.catalog.setCurrentDatabase("default")


def test_two_loads_at_a_time(spark, tmp_path, spec):
    """Loads in two threads of one driver neither delete nor mix what they stage."""
    found, failures = {}, []

    def load(label, movies):
        try:
            land = tmp_path / label
            land.mkdir()
            _write(land / "movie_1.json", movies)
            found[label] = refine.refine(
                spark, str(land), str(tmp_path / f"out_{label}"), f"both_{label}", spec,
                MOVIE_SCHEMA, MOVIE_ARRAY, MOVIE_DATASOURCE, name_glob=MOVIE_FILES,
            )
        except Exception as error:  # shown by the assertion below
            failures.append(error)

    threads = [
        threading.Thread(target=load, args=args)
        for args in (("a", MOVIES[:4]), ("b", MOVIES[4:]))
    ]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert failures == []
    counts = [read_table(spark, found[label]["bronze"]).count() for label in ("a", "b")]
    assert counts == [4, 8]
    spark.catalog.setCurrentDatabase("default")


def test_stages(spark, loaded, spec):
    fresh = loaded["bronze"].withColumn("status", F.lit("new"))
    first = refine.first_status(fresh, spec)
    assert first.filter("status = 'loaded'").count() == 4
    assert first.filter("status = 'quarantined'").count() == 8
    assert refine.loadable(fresh, loaded["attribute"], spec).count() == 8
    outcomes = refine.classified(fresh, spec).groupBy("outcome").count()
    assert dict(rows(outcomes, "outcome", "count")) == {"clean": 4, "repairable": 4, "unrepairable": 4}
    assert duplicates(fresh, "value").count() == 2


def test_row_without_record_stays_new(loaded, spec):
    empty = loaded["bronze"].limit(1).select(
        F.lit(None).cast(loaded["bronze"].schema["value"].dataType).alias("value"),
        "datasource", "ingesttime", F.lit("new").alias("status"), "ingestdate",
    )
    fresh = loaded["bronze"].withColumn("status", F.lit("new")).unionByName(empty.union(empty))
    for result in (refine.first_status(fresh, spec), refine.final_status(fresh, spec)):
        assert result.count() == 14
        assert rows(result.filter("value IS NULL"), "status") == [("new",), ("new",)]


EXPECTED = {
    "sf0.001": (1650, 6, 126, 6504, 1182, 468, 101, 332, 1615, 150, 1468, 1621, 29),
    "sf0.01": (16500, 6, 249, 65551, 11768, 4732, 1202, 3176, 16146, 1500, 14678, 16210, 290),
}


@pytest.mark.parametrize("scale", EXPECTED)
def test_derived_records(spark, scale):
    records = bronze(spark, f"/root/testdata/{scale}")
    languages = settle(refine.attribute_dimension(records, SPEC))
    first = refine.first_status(records, SPEC)
    quarantined = first.filter("status = 'quarantined'")
    repaired = refine.loadable(quarantined, languages, SPEC)
    low = refine.loadable(quarantined.filter("value.Budget < 100000"), languages, SPEC).count()
    final = dict(rows(refine.final_status(records, SPEC).groupBy("status").count(), "status", "count"))
    found = (
        records.count(),
        languages.count(),
        refine.tag_dimension(records, SPEC).count(),
        refine.bridge(records, SPEC).count(),
        first.filter("status = 'loaded'").count(),
        quarantined.count(),
        repaired.count() - low,
        low,
        refine.loadable(records, languages, SPEC).count(),
        duplicates(records, "value").count(),
        refine.silver(records, languages, SPEC).count(),
        final["loaded"],
        final["quarantined"],
    )
    assert found == EXPECTED[scale]


def test_one_pass_equals_the_chain_of_updates(spark):
    records = bronze(spark, "/root/testdata/sf0.001")
    languages = settle(refine.attribute_dimension(records, SPEC))
    silver, final = stepwise.refresh(records)
    for ours, theirs in (
        (refine.silver(records, languages, SPEC), silver),
        (refine.final_status(records, SPEC), final),
    ):
        assert ours.exceptAll(theirs).isEmpty() and theirs.exceptAll(ours).isEmpty()
