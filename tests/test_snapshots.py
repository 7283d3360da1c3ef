"""Snapshots behind a view: gap-free publishing and updates by partition."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from siltworks.operators.status import apply_status, merge_status
from siltworks.plans.updates import merge_partitions, update_partitions
from siltworks.sources import snapshots
from siltworks.sources.tables import register_table


def rows_of(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


def files_of(spark, table):
    """Files by partition folder, with what tells a rewritten file apart."""
    found = {}
    for spec, location in snapshots.partition_locations(spark, table).items():
        folder = location.removeprefix("file:")
        found[spec] = sorted((os.path.join(folder, f), os.stat(os.path.join(folder, f)).st_mtime_ns) for f in os.listdir(folder))
    return found


@pytest.fixture
def bronze(spark):
    """Records with nulls, copies over several partitions, and awkward partition values."""
    parts = ["a", "b", "it's", None, "a/b=c %", "2024-01-01", "back\\slash"]
    rows = [((i % 11, f"r{i % 11}") if i % 13 else None, "new", parts[i % 7]) for i in range(70)]
    return spark.createDataFrame(rows, "value struct<id: int, name: string>, status string, day string")


def published(spark, tmp_path, database, df, partition_by=("day",)):
    name, base = f"{database}.bronze", str(tmp_path / "bronze")
    snapshots.publish_swap(df, name, base, partition_by=partition_by)
    return name, base


def test_publish_swap(spark, tmp_path, database, bronze):
    name, base = published(spark, tmp_path, database, bronze)
    assert rows_of(spark.read.table(name)) == rows_of(bronze)
    first = snapshots.current_snapshot(spark, name)
    # From the table itself; other columns, partitions and format.
    again = spark.read.table(name).select("day", F.col("value.id").alias("id")).filter("id < 5")
    second = snapshots.publish_swap(again, name, base, fmt="orc", partition_by=["id"])
    assert spark.read.table(name).columns == ["day", "id"]
    assert rows_of(spark.read.table(name)) == rows_of(bronze.select("day", "value.id").filter("id < 5"))
    assert rows_of(spark.read.table(first)) == rows_of(bronze)
    third = snapshots.publish_swap(spark.read.table(name).filter("id > 100"), name, base, keep=2)
    assert spark.read.table(name).count() == 0 and spark.read.table(name).columns == ["day", "id"]
    assert snapshots.snapshots(spark, name) == [second, third]
    assert not spark.catalog.tableExists(first) and len(os.listdir(base)) >= 2
    assert spark.read.table(second).count() > 0


def test_table_makes_way(spark, tmp_path, database):
    name = f"{database}.plain"
    spark.range(3).write.parquet(str(tmp_path / "plain"))
    register_table(spark, name, str(tmp_path / "plain"))
    assert snapshots.current_snapshot(spark, name) is None
    snapshots.publish_swap(spark.read.table(name).filter("id > 0"), name, str(tmp_path / "new"))
    assert rows_of(spark.read.table(name)) == [(1,), (2,)]
    with pytest.raises(ValueError, match="no partitions"):
        snapshots.replace_partitions(spark, name, str(tmp_path / "new"), spark.range(1), lambda rows: rows)
    with pytest.raises(ValueError, match="not a published name"):
        snapshots.replace_partitions(spark, f"{database}.absent", str(tmp_path), spark.range(1), lambda rows: rows)


def test_reader_never_misses_the_table(spark, tmp_path, database):
    """A thread reads without a pause while partitioned snapshots change over."""
    name, base = f"{database}.busy", str(tmp_path / "busy")

    def content(n):
        return spark.range(60).select(F.lit(n).alias("n"), (F.col("id") % 3).alias("p"))

    snapshots.publish_swap(content(0), name, base, partition_by=["p"])
    found, failed, stop = [], [], threading.Event()

    def read():
        while not stop.is_set():
            try:
                found.append({(r["n"], r["count"]) for r in spark.read.table(name).groupBy("n").count().collect()})
            except Exception as error:  # noqa: BLE001  any gap counts
                failed.append(error)
                return

    reader = threading.Thread(target=read)
    reader.start()
    for n in range(1, 9):
        snapshots.publish_swap(content(n), name, base, partition_by=["p"])
    stop.set()
    reader.join()
    assert not failed and len(found) > 3
    # Each read is one snapshot, whole.
    assert all(len(one) == 1 and next(iter(one))[1] == 60 for one in found)
    seen = [next(iter(one))[0] for one in found]
    assert seen == sorted(seen) and len(set(seen)) > 1


@pytest.mark.parametrize("negate", [False, True])
@pytest.mark.parametrize("ids", [[3], [3, 5, 99], [], [99], list(range(11))])
def test_update(spark, tmp_path, database, bronze, negate, ids):
    name, base = published(spark, tmp_path, database, bronze)
    wanted_ids = [(i, f"r{i}") for i in ids]
    keys = spark.createDataFrame([(i,) for i in wanted_ids], "value struct<id: int, name: string>")
    before = files_of(spark, snapshots.current_snapshot(spark, name))
    changed = update_partitions(spark, name, base, keys, "loaded", negate=negate)
    found = spark.read.table(name)
    assert rows_of(found) == rows_of(apply_status(bronze, keys, "loaded", negate=negate))
    after = files_of(spark, snapshots.current_snapshot(spark, name))
    touched = {row["day"] for row in found.filter("status = 'loaded'").select("day").distinct().collect()}
    assert {row["day"] for row in changed} == touched
    assert set(before) == set(after)
    for spec, files in before.items():
        value = None if spec[0][1] == snapshots.NULL_PARTITION else spec[0][1]
        assert (after[spec] == files) == (value not in touched)


def test_update_reads_touched_partitions_only(spark, tmp_path, database, bronze):
    name, base = published(spark, tmp_path, database, bronze)
    plans = []

    def change(rows):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return rows.withColumn("status", F.lit("seen"))

    touched = spark.createDataFrame([("it's",), (None,)], "day string")
    snapshots.replace_partitions(spark, name, base, touched, change)
    assert "PartitionFilters: [(day" in plans[0] or "PartitionFilters: [((day" in plans[0]
    found = spark.read.table(name).filter("status = 'seen'").select("day").distinct()
    assert rows_of(found) == rows_of(touched)
    # Rows that leave their partition are an error, and the table stays.
    before = rows_of(spark.read.table(name))
    with pytest.raises(ValueError, match="moved"):
        snapshots.replace_partitions(spark, name, base, touched, lambda rows: rows.withColumn("day", F.lit("a")))
    assert rows_of(spark.read.table(name)) == before
    # A partition without rows goes.
    snapshots.replace_partitions(spark, name, base, touched, lambda rows: rows.filter("day is not null"))
    assert (snapshots.NULL_PARTITION,) not in {
        tuple(v for _, v in spec) for spec in snapshots.partition_locations(spark, snapshots.current_snapshot(spark, name))
    }


def test_two_partition_columns(spark, tmp_path, database):
    df = spark.range(40).select(
        "id", F.lit("new").alias("status"),
        F.when(F.col("id") % 5 > 0, F.to_date(F.lit("2024-01-01")) + (F.col("id") % 5).cast("int")).alias("day"),
        (F.col("id") % 2).cast("int").alias("odd"),
    )
    name, base = published(spark, tmp_path, database, df, ("day", "odd"))
    updates = spark.createDataFrame([(7, "x"), (10, "y"), (7, "x"), (None, "z")], "id long, status string")
    before = files_of(spark, snapshots.current_snapshot(spark, name))
    changed = merge_partitions(spark, name, base, updates, "id", keep=1)
    assert rows_of(spark.read.table(name)) == rows_of(merge_status(df, updates, "id"))
    assert len(changed) == 2 and len(snapshots.snapshots(spark, name)) == 1
    # Files that the first snapshot wrote are still there where the second took them over.
    after = files_of(spark, snapshots.current_snapshot(spark, name))
    assert sum(before[spec] == after[spec] for spec in before) == len(before) - 2
    # And again on top; the replaced folders of the snapshot in between go with it.
    merge_partitions(spark, name, base, updates.withColumn("status", F.lit("w")).filter("id = 7"), "id", keep=1)
    assert spark.read.table(name).filter("status = 'w'").count() == 1
    assert spark.read.table(name).count() == 40
