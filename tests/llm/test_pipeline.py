"""The pipeline's stages, and its result against plain steps."""

import pytest

import corpus_pipeline
from siltworks.llm import language, simhash
from tests.llm.conftest import as_multiset
from tests.llm.test_copies import plain_groups, plain_print
from tests.llm.test_rules import plain_contamination, plain_spans

SF_DIR = "/root/testdata/sf0.001"


def test_stages(spark):
    """Each stage's rows are what its rule makes of its predecessor's."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    benchmark = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    columns = docs.columns
    results = []
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
        rows = docs.collect()
        docs = spark.createDataFrame(rows, docs.schema)
        results.append([tuple(r) for r in rows])
    start = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    known, single, clean, masked, packed = results
    # The texts are prose in known languages; hardly any is too unlike all of them.
    scored = language.languages(spark.read.parquet(f"{SF_DIR}/documents.parquet")).collect()
    sure = {r["doc_id"] for r in scored if r["lang_pred"] != "und" and r["score"] >= 0.3}
    assert as_multiset(known) == as_multiset(r for r in start if r[0] in sure)
    assert len(known) >= 0.98 * len(start)
    groups = plain_groups([plain_print(r[1]) for r in known], simhash.DISTANCE)
    first = {}
    for group, row in zip(groups, known):
        first[group] = min(first.get(group, row), row)
    assert as_multiset(single) == as_multiset(first.values())
    bad = {r[0] for r in plain_contamination(single, benchmark) if r[5]}
    assert bad and as_multiset(clean) == as_multiset(r for r in single if r[0] not in bad)
    before = {r[0]: r for r in clean}
    assert {r[0] for r in masked} == set(before)
    for row in masked:
        assert plain_spans(row[1]) == [] and row[2:] == before[row[0]][2:]
        if not plain_spans(before[row[0]][1]):
            assert row[1] == before[row[0]][1]
    assert {r[0] for r in packed} == set(before)
    assert docs.columns[:2] == ["doc_id", "piece"] and columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_run(spark):
    found = corpus_pipeline.run(spark, SF_DIR)
    assert found.count() > 100 and "sequence_id" in found.columns


@pytest.mark.parametrize("number", range(5))
def test_awkward_and_empty(spark, awkward, nothing, number):
    name, stage = corpus_pipeline.STAGES[number]
    found = stage(spark, awkward, SF_DIR)
    assert found.count() > 0
    if number < 4:
        assert found.columns == awkward.columns
    assert stage(spark, nothing, SF_DIR).count() == 0


def test_rejected_language(spark, awkward):
    found = {r["doc_id"] for r in corpus_pipeline.known_language(spark, awkward, SF_DIR).collect()}
    assert not found & {4, 5, 6} and language.UNDETERMINED == "und"
