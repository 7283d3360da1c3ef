"""Final status and silver against the row-level steps, played through in plain Python."""

from collections import Counter

from hypothesis import HealthCheck, given, settings, strategies as st

from siltworks.plans import refine
from siltworks.plans.spec import movie_spec
from siltworks.staging import settle

SPEC = movie_spec(minimum_budget=10)
SCHEMA = """
    value struct<Id: bigint, Budget: double, RunTime: bigint, OriginalLanguage: string,
                 genres: array<struct<id: bigint, name: string>>>,
    status string
"""

TAG = st.tuples(st.integers(0, 1), st.sampled_from(["a", "", None]))
RECORD = st.tuples(
    st.integers(0, 2),
    st.sampled_from([None, 5.0, 10.0, 20.0]),
    st.sampled_from([None, -3, 0, 3]),
    st.sampled_from([None, "en", "fr"]),
    st.one_of(st.none(), st.lists(TAG, max_size=2).map(tuple)),
)


def steps(records):
    """Status per record in input order, and the set of silver rows."""
    languages = sorted({r[3] for r in records}, key=lambda v: (v is not None, v))
    key = {language: i + 1 for i, language in enumerate(languages) if language is not None}
    clean = [
        r for r in records
        if r[1] is not None and r[1] >= 10 and r[2] is not None and r[2] >= 0 and r[3] in key
    ]
    status = ["loaded" if r in set(clean) else "quarantined" for r in records]
    silver = [(r[0], r[1], r[2], key[r[3]]) for r in clean]
    dirty = [r for r, s in zip(records, status) if s == "quarantined" and r[1] is not None and r[3] in key]
    for r in dirty:
        runtime = None if r[2] is None else abs(r[2])
        silver.append((r[0], max(r[1], 10.0), runtime, key[r[3]]))
    loaded = set(dirty) | {r for r, n in Counter(records).items() if n > 1}
    status = ["loaded" if r in loaded else s for r, s in zip(records, status)]
    return status, set(silver)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(RECORD, min_size=1, max_size=25).flatmap(
    lambda rows: st.lists(st.sampled_from(rows), max_size=8).map(lambda again: rows + again)
))
def test_matches_the_steps(spark, records):
    bronze = settle(spark.createDataFrame([(r, "new") for r in records], SCHEMA).coalesce(1))
    status, silver = steps(records)
    found = refine.final_status(bronze, SPEC).collect()

    def plain(value):
        tags = None if value.genres is None else tuple((t.id, t.name) for t in value.genres)
        return (value.Id, value.Budget, value.RunTime, value.OriginalLanguage, tags)

    assert Counter((plain(r.value), r.status) for r in found) == Counter(zip(records, status))
    languages = settle(refine.attribute_dimension(bronze, SPEC))
    rows = [tuple(r) for r in refine.silver(bronze, languages, SPEC).collect()]
    assert len(rows) == len(set(rows)) and set(rows) == silver
