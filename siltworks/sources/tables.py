"""Table sinks, external tables and snapshot publishing."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql.types import StructType

from siltworks.session import open_files
from siltworks.staging import delete_folder

# Partitions that a task writes side by side. A Parquet writer holds up to a row group of 128 MB.
PARTITIONS_OPEN = 4


def read_table(spark: SparkSession, table: str) -> DataFrame:
    """Scan a catalog table by name."""
    return spark.read.table(table)


def table_writer(
    df: DataFrame,
    exclude: Sequence[str] = (),
    mode: str = "append",
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    compact: bool = False,
) -> DataFrameWriter:
    """An unstarted writer without the ``exclude`` columns; names not present are passed over.

    ``compact`` suits many partition values per task: rows of one partition are
    brought together before the write, which avoids a file per task and value, and
    adaptive execution still splits a partition that is too large for one task.
    """
    df = df.drop(*exclude)
    if compact and partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.format(fmt).mode(mode)
    return writer.partitionBy(*partition_by) if partition_by else writer


def write_table(df: DataFrame, path: str, **options) -> None:
    """Write to ``path``; options are those of :func:`table_writer`.

    The rows of the first ``PARTITIONS_OPEN`` partitions that a task meets are written as they
    come, so a table with few partitions is not sorted by them.
    """
    with open_files(df.sparkSession, PARTITIONS_OPEN):
        table_writer(df, **options).save(path)


def ensure_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    """Create a database if it is missing and make it current."""
    clause = " LOCATION :location" if location else ""
    args = {"database": database, **({"location": location} if location else {})}
    spark.sql(f"CREATE DATABASE IF NOT EXISTS IDENTIFIER(:database){clause}", args=args)
    spark.catalog.setCurrentDatabase(database)


def drop_database(spark: SparkSession, database: str) -> None:
    """Drop a database with its tables; external data stays where it is."""
    spark.sql("DROP DATABASE IF EXISTS IDENTIFIER(:database) CASCADE", args={"database": database})


def register_table(
    spark: SparkSession,
    table: str,
    path: str,
    fmt: str = "parquet",
    partitioned: bool = False,
    schema: StructType | None = None,
    partition_by: Sequence[str] = (),
) -> None:
    """Point a catalog name at existing files, replacing an earlier table of that name.

    Partitions of a ``partitioned`` layout, or one with ``partition_by`` columns, are looked
    up and registered. With a ``schema`` no file is read for it, and there may be none.
    """
    spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:table)", args={"table": table})
    if schema is None:
        spark.catalog.createTable(table, path=path, source=fmt)
    else:
        names = ", ".join(f"`{name.replace('`', '``')}`" for name in partition_by)
        clause = f" PARTITIONED BY ({names})" if names else ""
        spark.sql(
            f"CREATE TABLE IDENTIFIER(:table) ({schema.toDDL()}) USING {fmt}{clause} LOCATION :path",
            args={"table": table, "path": path},
        )
    if partitioned or partition_by:
        spark.catalog.recoverPartitions(table)


def name_frame(df: DataFrame, name: str) -> None:
    """Give a frame a name for SQL of its session, replacing an earlier one."""
    df.createOrReplaceTempView(name)


def _provider(spark: SparkSession, table: str) -> str:
    rows = spark.sql("DESCRIBE TABLE EXTENDED IDENTIFIER(:table)", args={"table": table})
    found = rows.filter("col_name = 'Provider'").first()
    return found["data_type"] if found else ""


def _same_layout(df: DataFrame, table: str, fmt: str) -> bool:
    """Whether the table exists, is unpartitioned and has the format and columns of ``df``."""
    spark = df.sparkSession
    catalog = spark.catalog
    if not catalog.tableExists(table) or _provider(spark, table).lower() != fmt.lower():
        return False
    columns = catalog.listColumns(table)
    named = [(column.name, column.dataType) for column in columns]
    return named == df.dtypes and not any(column.isPartition for column in columns)


def publish(
    df: DataFrame,
    table: str,
    base: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    keep: int | None = None,
) -> str:
    """Write ``df`` as a new snapshot below ``base`` and make it the table's content.

    ``df`` may read the table itself: the files it reads stay until the new ones
    are complete, and afterwards for queries that are still running. An
    unpartitioned table of the same columns and format changes over in one catalog
    operation; others are dropped and created again, as catalogs keep a location per
    partition. Of all snapshots the last ``keep`` stay, or all without it. Returns the
    path of the snapshot.
    """
    spark = df.sparkSession
    in_place = not partition_by and _same_layout(df, table, fmt)
    path = f"{base.rstrip('/')}/snapshot-{time.time_ns():020d}-{uuid.uuid4().hex}"
    write_table(df, path, mode="errorifexists", fmt=fmt, partition_by=partition_by)
    if in_place:
        spark.sql(
            "ALTER TABLE IDENTIFIER(:table) SET LOCATION :path",
            args={"table": table, "path": path},
        )
        spark.catalog.refreshTable(table)
    else:
        register_table(spark, table, path, fmt, schema=df.schema, partition_by=partition_by)
    if keep is not None:
        expire_snapshots(spark, base, keep)
    return path


def expire_snapshots(spark: SparkSession, base: str, keep: int) -> list[str]:
    """Delete all but the last ``keep`` snapshots below ``base``; the last one always stays.

    Queries that still read an older one fail, so keep as many as run at a time.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(base)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = sorted(
        status.getPath().getName()
        for status in system.listStatus(folder)
        if status.getPath().getName().startswith("snapshot-")
    )
    gone = names[: -max(keep, 1)]
    for name in gone:
        delete_folder(spark, f"{base.rstrip('/')}/{name}")
    return gone
