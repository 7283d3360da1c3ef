"""Drifting layouts, observed checks, and a stream refined by loads."""

import json
import os
from collections import Counter

from pyspark.sql import functions as F

from siltworks import staging
from siltworks.plans import checks, increment, refine
from siltworks.plans.checks import ObservedState
from siltworks.plans.spec import MOVIE_ARRAY, MOVIE_DATASOURCE, MOVIE_FILES, MOVIE_SCHEMA, movie_spec
from siltworks.sources import variants
from siltworks.sources.tables import read_table
from siltworks.staging import staged_path
from siltworks.streaming import landing, refresh
from tests.test_refine import MOVIES, _write


def test_variant(spark, tmp_path):
    lines = [
        {"id": 1, "name": "a", "tags": [{"id": 1}]}, {"id": "2", "name": None}, {"id": "x", "odd key": 1.5},
        {"id": 3.0, "more": {"deep": True, "er": [1]}, "tags": [{"id": 2, "label": "z"}, 5]}, {},
    ]
    (tmp_path / "a.json").write_text("\n".join(json.dumps(x) for x in lines[:3]))
    (tmp_path / "b.json").write_text("\n".join(json.dumps(x) for x in lines[3:]))
    found = variants.read_variant(spark, str(tmp_path))
    rows = variants.typed(
        found, {"id": "bigint", "name": "string", "deep": ("$.more.deep", "boolean"), "odd key": "double"}
    ).collect()
    assert Counter(map(tuple, rows)) == Counter(
        [(1, "a", None, None), (2, None, None, None), (None, None, None, 1.5), (3, None, True, None), (None,) * 4]
    )
    known = spark.createDataFrame([], "id bigint, NAME string, tags array<struct<id: bigint>>").schema
    unknown = {r["path"]: (r["type"], r["documents"]) for r in variants.unknown_paths(found, known).collect()}
    assert unknown.keys() >= {"$['odd key']", "$.more"} and unknown["$.more"][1] == 1
    assert not any(path.startswith("$.more.") for path in unknown)
    whole = spark.createDataFrame([], "id bigint, name string, tags array<variant>, more variant, `odd key` double").schema
    assert variants.unknown_paths(found, whole).count() == 0
    # Nested in an array of objects.
    nested = [{"tags": [{"id": 1, "label": "z"}]}, {"tags": [{"id": 2}]}, {"tags": []}]
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "c.json").write_text("\n".join(json.dumps(x) for x in nested))
    below = variants.unknown_paths(variants.read_variant(spark, str(tmp_path / "c")), known).collect()
    assert [tuple(r) for r in below] == [("$.tags[].label", "string", 3)]


def test_observed_checks(spark, tmp_path):
    """Counts that come with the writing jobs equal those of scans, and take no job."""
    spec, land = movie_spec(), tmp_path / "land"
    land.mkdir()
    _write(land / "movie_0.json", MOVIES)
    (land / "movie_broken.json").write_text('{"movie": [')
    state = ObservedState(spec)
    named = refine.refine(
        spark, str(land), str(tmp_path / "out"), "observed", spec, MOVIE_SCHEMA, MOVIE_ARRAY,
        MOVIE_DATASOURCE, name_glob=MOVIE_FILES, state=state,
    )
    spark.sparkContext.setJobGroup("observed counts", "")
    counts = state.counts(spark)
    spark.sparkContext._jsc.clearJobGroup()
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("observed counts")
    scanned = checks.end_state(
        *(read_table(spark, named[role]) for role in ("bronze", "silver", "tag")), spec, read_table(spark, named["unreadable"])
    )
    assert Counter(map(tuple, counts.collect())) == Counter(map(tuple, scanned.collect()))
    spark.catalog.setCurrentDatabase("default")


def state_of(layers):
    return {
        role: Counter(str(r) for r in layers.read(role).drop("ingesttime").collect())
        for role in ("bronze", "silver", "tag", "attribute", "bridge")
    }


def test_stream(spark, tmp_path, database):
    """Batches are loads; one that runs again changes nothing."""
    spec, land, checkpoint = movie_spec(), tmp_path / "land", str(tmp_path / "checkpoint")
    land.mkdir()
    _write(land / "movie_0.json", MOVIES[:7])
    _write(land / "movie_1.json", MOVIES[7:])
    layers = increment.Layers(spark, staged_path(spark, "layers"), database, spec, buckets=4)

    def run():
        stream = landing.stream_landing(spark, str(land), MOVIE_SCHEMA, name_glob="movie*", files_per_batch=1)
        refresh.refine_available(stream, layers, "movie", "x", checkpoint).awaitTermination()

    run()
    assert len(layers.finished()) == 2 and layers.read("bronze").count() == len(MOVIES)
    before = state_of(layers)
    # Without its entry in the checkpoint, Spark runs the last batch again.
    for name in ("1", ".1.crc"):
        os.replace(f"{checkpoint}/commits/{name}", tmp_path / f"away{name}")
    run()
    assert state_of(layers) == before and len(layers.finished()) == 2
    _write(land / "movie_2.json", [(30, 2e6, 1, "it", [])])
    run()
    assert len(layers.finished()) == 3 and layers.read("silver").filter("Id = 30").count() == 1


def test_stream_stages_a_batch_once(spark, tmp_path, database, monkeypatch):
    """A batch is read once, into the rows of its load; a first silver is not written twice."""
    spec, land, labels = movie_spec(), tmp_path / "land", []
    land.mkdir()
    _write(land / "movie_0.json", MOVIES)
    layers = increment.Layers(spark, staged_path(spark, "layers"), database, spec, buckets=4)

    def noted(session, label):
        labels.append(label)
        return staged_path(session, label)

    for module in (staging, increment, refresh):
        monkeypatch.setattr(module, "staged_path", noted, raising=False)
    stream = landing.stream_landing(spark, str(land), MOVIE_SCHEMA, name_glob="movie*")
    refresh.refine_available(stream, layers, "movie", "x", str(tmp_path / "checkpoint")).awaitTermination()
    assert layers.read("bronze").count() == len(MOVIES)
    assert labels.count("load") == 1 and "batch" not in labels and "silver" not in labels
