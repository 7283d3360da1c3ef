"""Operators on tables that grow: keys, copies and changes over several loads."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from siltworks.operators import distinct
from siltworks.operators.changes import changes
from siltworks.operators.keys import dense_key, extend_keys
from siltworks.operators.ledger import duplicates_across, remember, remembered
from siltworks.staging import settle, staged_path


def multiset(df):
    return Counter(tuple(row) for row in df.collect())


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_extend_keys(spark):
    schema = "name string, size int"
    first = spark.createDataFrame([("b", 1), ("a", 2), ("b", 1), ("c", None)], schema)
    known = settle(dense_key(first.distinct(), "id", ["name", "size"]))
    before = multiset(known)
    more = [("b", 1), ("z", 1), (None, 5), ("aa", 0), (None, 5), ("z", 1), ("c", None), ("c", 0)]
    second = settle(extend_keys(known, spark.createDataFrame(more, schema), "id", ["name", "size"]))
    assert second.columns == known.columns
    assert multiset(second) == before + Counter({(4, None, 5): 1, (5, "aa", 0): 1, (6, "c", 0): 1, (7, "z", 1): 1})
    # Nothing new, no load, and no known value.
    assert multiset(extend_keys(second, first, "id", ["name", "size"])) == multiset(second)
    assert multiset(extend_keys(second, first.limit(0), "id", ["name", "size"])) == multiset(second)
    empty = settle(known.limit(0))
    assert multiset(extend_keys(empty, first, "id", ["name", "size"])) == before


def wide(spark, n=3000, share=0.3):
    """Wide rows of which a share are copies, with nulls."""
    repeated = int(n * share / 3)
    return spark.range(n).select(
        F.when(F.col("id") < 3 * repeated, F.col("id") % repeated).otherwise(F.col("id")).alias("n")
    ).select(
        F.when(F.col("n") % 50 > 0, F.col("n")).alias("n"), F.repeat(F.sha2(F.col("n").cast("string"), 256), 20).alias("text"),
        F.struct((F.col("n") % 7).alias("a"), F.lit(None).cast("string").alias("b")).alias("s"),
    )


@pytest.mark.parametrize("share", [0.0, 0.3, 1.0])
def test_distinct_records(spark, settings, share):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    df = settle(wide(spark, share=share))
    assert multiset(distinct.distinct_records(df)) == multiset(df.distinct())
    assert distinct.distinct_records(df).columns == df.columns


def test_distinct_records_beyond_the_bitmap(spark, monkeypatch):
    """A bitmap that is too small only sends more rows to the comparison."""
    monkeypatch.setattr(distinct, "LEAST_BITS", 1 << 3)
    monkeypatch.setattr(distinct, "MOST_BITS", 1 << 3)
    df = settle(wide(spark, 500))
    assert multiset(distinct.distinct_records(df)) == multiset(df.distinct())


def test_marks(spark):
    rng = random.Random(3)
    hashes = [rng.getrandbits(64) - (1 << 63) for _ in range(500)] + [0, -1, (1 << 63) - 1, -(1 << 63)]
    some = spark.createDataFrame([(x,) for x in hashes], "_row_key long")
    for bits in (1 << 15, 1 << 20):
        marks = distinct.hash_marks(some, bits)
        assert marks.agg(F.max(F.length("_marks"))).first()[0] == 4096
        others = spark.range(-2000, 2000).select(F.xxhash64("id").alias("_row_key")).union(some)
        places = {x % bits for x in hashes}
        for key, again in distinct.marked(others, marks, bits, "again").collect():
            assert again == (key % bits in places)


def test_unique_records_are_not_shuffled(spark, settings, monkeypatch):
    """With three in ten rows repeated and broadcasts off: two readings, and no unique row moves."""
    settings(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    df = settle(wide(spark, 6000))
    written = []
    plain = distinct.staged_path

    def noted(session, label):
        written.append(plain(session, label))
        return written[-1]

    monkeypatch.setattr(distinct, "staged_path", noted)
    reads = spark.sparkContext.accumulator(0)
    counted = df.mapInPandas(lambda frames: (reads.add(len(f)) or f for f in frames), df.schema)
    found = distinct.distinct_records(counted)
    assert multiset(found) == multiset(df.distinct())
    assert reads.value == 2 * 6000
    # What went to the comparison are the repeated rows and the few that share a bit with one.
    compared = spark.read.parquet(written[0]).filter("_again = 'true'")
    repeated = df.groupBy(*df.columns).count().filter("count > 1").agg(F.sum("count")).first()[0]
    assert repeated <= compared.count() <= repeated + 6000 * 2 / distinct.BITS_PER_REPEATED
    # The branch of unique rows is a scan; the one exchange is of the other branch.
    plan = plan_of(found)
    assert plan.count("Exchange") == 1
    single = plan_of(found.sparkSession.read.parquet(written[0]).filter("not _again"))
    assert "Exchange" not in single


def plain_changes(before, after):
    old, new = Counter(before), Counter(after)
    return {
        (*row, old[row], new[row], "added" if not old[row] else "removed" if not new[row] else "copies")
        for row in old | new if old[row] != new[row]
    }


@pytest.mark.parametrize("threshold", ["-1", "10MB"])
def test_changes(spark, settings, threshold):
    settings(spark__sql__autoBroadcastJoinThreshold=threshold)
    schema = "a int, b string, c struct<d: double>"
    before = [(1, "x", (1.0,)), (1, "x", (1.0,)), (2, None, None), (None, None, None), (3, "y", (None,)), (4, "z", (0.5,))]
    after = [(1, "x", (1.0,)), (2, None, None), (2, None, None), (None, None, None), (3, "y", None), (5, "", (0.5,))]
    one, two = spark.createDataFrame(before, schema), spark.createDataFrame(after, schema)
    found = changes(one, two.select("c", "b", "a"))
    assert found.columns == ["a", "b", "c", "before", "after", "change"]
    assert {tuple(tuple(v) if isinstance(v, tuple) else v for v in row) for row in found.collect()} == plain_changes(before, after)
    assert changes(one, one).count() == 0
    assert changes(one.limit(0), one).agg(F.sum("after")).first()[0] == 6
    assert {r["change"] for r in changes(one, one.limit(0)).collect()} == {"removed"}


@pytest.fixture
def ledger(spark, database):
    return f"{database}.seen", staged_path(spark, "seen")


def test_duplicates_across_loads(spark, ledger):
    table, path = ledger
    rng = random.Random(5)
    loads = [[rng.choice(["a", "b", None, "c", f"only {i}", f"pair {i % 20}"]) for i in range(60)] for _ in range(3)]
    loads.insert(1, [])
    seen = Counter()
    for load in loads:
        df = spark.createDataFrame([(x,) for x in load], "value string")
        now = Counter(load)
        wanted = {(x, now[x] + seen[x], seen[x]) for x in now if now[x] + seen[x] > 1}
        found = duplicates_across(df, "value", table)
        assert found.columns == ["value", "copies", "earlier"]
        assert {tuple(row) for row in found.collect()} == wanted
        remember(df, "value", table, path, buckets=8)
        seen += now


def test_ledger_is_read_in_place(spark, ledger, settings):
    """Hashes of a new load are dealt out; those of the ledger are not."""
    settings(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    table, path = ledger
    for start in (0, 500):
        remember(spark.range(start, start + 1000).select(F.struct("id").alias("value")), "value", table, path, buckets=8)
    new = spark.range(1200, 1800).select(F.struct("id").alias("value"))
    found = remembered(new, "value", table)
    plan = plan_of(found)
    side = plan[plan.index("SortMergeJoin") :]
    scan = next(line for line in side.splitlines() if "FileScan" in line and "Bucketed: true" in line)
    assert "SelectedBucketsCount: 8 out of 8" in scan
    # From the join down to the ledger's scan there are aggregates and sorts alone.
    lines = side.splitlines()
    at = lines.index(scan)
    depth = len(scan) - len(scan.lstrip(" :+-*"))
    above = []
    for line in reversed(lines[:at]):
        own = len(line) - len(line.lstrip(" :+-*"))
        if own < depth:
            above.append(line)
            depth = own
    assert any("SortMergeJoin" in line for line in above)
    assert not any("Exchange" in line for line in above)
    assert found.filter("_earlier = 1").count() == 300 and found.count() == 600
