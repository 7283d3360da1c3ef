"""Every registered query against its SQL, on the smallest data folder."""

from datetime import date

import pytest
from pyspark.sql import DataFrameWriter

import __spark_entry__ as entry
from workload.oracle import all_sql
from workload.queries import REGISTRY
from tests.compare import differences, sql_connection

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return sql_connection(SF_DIR)


@pytest.mark.parametrize("name", REGISTRY)
def test_query(spark, connection, name):
    df = entry.queries()[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    assert differences(df, connection, entry.oracle_sql()[name]) is None


def test_every_query_has_sql():
    assert set(REGISTRY) == set(all_sql())
    assert set(REGISTRY) <= set(entry.queries()) and set(all_sql()) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() == 1468


def test_landing_is_packed_once(spark, monkeypatch, tmp_path):
    """What lies below the landing folder of a full refresh is copied from it, line by line."""
    packed, folders, plain = [], [], {name: getattr(DataFrameWriter, name) for name in ("json", "text")}

    def noted(name, paths):
        def write(self, path, *args, **options):
            paths.append(path)
            return plain[name](self, path, *args, **options)

        monkeypatch.setattr(DataFrameWriter, name, write)

    noted("json", packed)
    noted("text", folders)
    for name, schema, rows in (
        ("part", "p_partkey long, p_size int, p_type string", [(1, 4, "PROMO"), (2, 5, "ECO")]),
        ("customer", "c_custkey long, c_acctbal double", [(1, 10.5)]),
        ("lineitem", "l_orderkey long, l_partkey long", [(i, i % 2 + 1) for i in range(40)]),
        ("orders", "o_orderkey long, o_custkey long, o_totalprice double, o_orderpriority string, o_orderdate date",
         [(i, i % 2, i * 1e4, "1-URGENT", date(2024, 1, 1)) for i in range(40)]),
    ):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    REGISTRY["q_full_refresh"](spark, str(tmp_path))
    assert len(packed) == 1 and len(folders) == 2
    lines = sorted(row[0] for row in spark.read.text(f"{packed[0]}/part-*").collect())
    assert lines and all(sorted(row[0] for row in spark.read.text(path).collect()) == lines for path in folders)
