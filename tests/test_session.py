import threading
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from siltworks import session
from siltworks.operators import distinct
from siltworks.session import sized_session, with_shared_folder
from siltworks.sources import documents, tables
from siltworks.staging import passing, settle, shared_folder, staged_path

NAME = "spark.sql.shuffle.partitions"


def test_partitions_grow_with_the_input(spark, settings):
    settings(spark__sql__adaptive__advisoryPartitionSizeInBytes="12345")
    before = spark.conf.get(NAME)
    assert sized_session(spark, 10 << 30).conf.get(NAME) == "80"
    assert sized_session(spark, 100 << 40).conf.get(NAME) == str(100 << 13)
    own = sized_session(spark, 5)
    assert own.conf.get(NAME) == before
    assert own.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "12345"
    assert spark.conf.get(NAME) == before


def folder_of(df):
    (folder,) = {Path(name.removeprefix("file:")).parent for name in df.inputFiles()}
    return folder


def test_passing_tables_are_deleted(spark):
    kept = settle(spark.range(3))
    with passing(spark):
        gone = folder_of(settle(spark.range(3)))
        assert gone.exists()
    assert not gone.exists()
    assert kept.count() == 3
    with pytest.raises(ValueError), passing(spark):
        failed = folder_of(settle(spark.range(3)))
        raise ValueError
    assert not failed.exists()


def test_nested_blocks_keep_their_own(spark):
    with passing(spark):
        with passing(spark):
            pass
        outer = folder_of(settle(spark.range(3)))
        with passing(spark):
            inner = folder_of(settle(spark.range(3)))
        assert outer.exists() and not inner.exists()
    assert not outer.exists()


def test_blocks_of_other_threads_are_left_alone(spark):
    """What one thread stages while another's block is open stays when that block ends."""
    opened, staged, closed = (threading.Event() for _ in range(3))
    seen = {}

    def first():
        seen["first"] = folder_of(settle(spark.range(3)))
        opened.wait(60)
        seen["second"] = folder_of(settle(spark.range(3)))
        staged.set()
        closed.wait(60)
        seen["there"] = seen["second"].exists()

    thread = threading.Thread(target=first)
    thread.start()
    with passing(spark):
        opened.set()
        staged.wait(60)
        own = folder_of(settle(spark.range(3)))
    closed.set()
    thread.join()
    assert seen["there"] and not own.exists()


def test_plain_tables_are_as_large_as_their_values(spark):
    """Long equal texts compress to nothing, and a broadcast would hold them in full."""
    texts = spark.range(200).selectExpr("id", "repeat('x', 50000) AS text")
    small, plain = settle(texts), settle(texts, plain=True)
    sizes = [sum(f.stat().st_size for f in folder_of(df).glob("*.parquet")) for df in (small, plain)]
    assert sizes[0] < 1_000_000 < 10_000_000 <= sizes[1]


def test_a_session_must_name_the_shared_folder(spark):
    def session(master, conf_folder=None, context_folder=None):
        named = []
        context = SimpleNamespace(
            master=master, getCheckpointDir=lambda: context_folder or (named or [None])[0],
            setCheckpointDir=named.append,
        )
        conf = SimpleNamespace(get=lambda key, default: conf_folder)
        return SimpleNamespace(conf=conf, sparkContext=context)

    assert shared_folder(session("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    assert shared_folder(session("yarn", None, "hdfs:///set")) == "hdfs:///set"
    for master in ("yarn", "local[2]", "local-cluster[3,2,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_folder(session(master))
    for master in ("local", "local[2]", "local[*]"):
        assert Path(shared_folder(with_shared_folder(session(master)))).is_dir()
    with pytest.raises(RuntimeError):
        shared_folder(with_shared_folder(session("local-cluster[3,2,1024]")))
    folder = shared_folder(spark)
    assert staged_path(spark, "x").startswith(folder + "/")


def test_writes_by_partition_need_no_sort(spark, tmp_path, monkeypatch):
    """Rows of a few partitions are written as they come; of many, the rest is sorted."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before, seen = spark.conf.get(name, None), []
    rows = spark.range(2000, numPartitions=2).select("id", (F.col("id") % 8).cast("int").alias("chunk"))

    def noted(method):
        plain = getattr(DataFrameWriter, method)

        def write(self, path):
            seen.append(int(spark.conf.get(name)))
            return plain(self, path)

        monkeypatch.setattr(DataFrameWriter, method, write)

    for method in ("json", "save", "parquet"):
        noted(method)
    documents.write_chunks(rows, f"{tmp_path}/chunks")
    tables.write_table(rows, f"{tmp_path}/table", partition_by=["chunk"])
    distinct.distinct_records(rows.union(rows.filter("id < 5"))).count()
    assert seen[0] >= 8 and seen[1] < 8 and seen[-1] == 2
    assert spark.conf.get(name, None) == before
    for found in (spark.read.schema("id long, chunk int").json(f"{tmp_path}/chunks"), spark.read.parquet(f"{tmp_path}/table")):
        assert sorted(map(tuple, found.select("id", "chunk").collect())) == [(i, i % 8) for i in range(2000)]
    spark.sql("CREATE TABLE open_files_test (id bigint, chunk int) USING parquet PARTITIONED BY (chunk)")
    try:
        rows.createOrReplaceTempView("open_files_rows")
        insert = "EXPLAIN INSERT INTO open_files_test SELECT id, chunk FROM open_files_rows"
        assert "Sort [" in spark.sql(insert).first()[0]
        with session.open_files(spark, 8):
            assert "Sort [" not in spark.sql(insert).first()[0]
    finally:
        spark.sql("DROP TABLE open_files_test")
