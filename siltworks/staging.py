"""Staged tables in the folder all executors share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# What the blocks that are open in this thread or task have staged, outermost first.
_passing: ContextVar[tuple[list[str], ...]] = ContextVar("passing", default=())


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, or by the context's checkpoint folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise RuntimeError("spark.checkpoint.dir must name a folder that every executor can reach")
    return folder.rstrip("/")


def staged_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    application = spark.sparkContext.applicationId
    path = f"{shared_folder(spark)}/staged/{application}/{label}-{uuid.uuid4().hex}"
    blocks = _passing.get()
    if blocks:
        blocks[-1].append(path)
    return path


def delete_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Delete what a block stages when the block ends.

    For blocks that write their results elsewhere and leave no frame that reads a
    staged table. Blocks of other threads are not touched.
    """
    paths: list[str] = []
    token = _passing.set((*_passing.get(), paths))
    try:
        yield
    finally:
        _passing.reset(token)
        for path in paths:
            delete_folder(spark, path)


def settle(df: DataFrame, label: str = "frame", plain: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and return the written table.

    The table cuts the lineage and survives lost executors. Catalyst takes the size of its
    files for the size of the frame; ``plain`` writes values as they are, without
    compression or dictionaries, so that this holds and a join against the table is a
    broadcast only while its values are below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    spark = df.sparkSession
    path = staged_path(spark, label)
    writer = df.write
    if plain:
        writer = writer.option("compression", "none").option("parquet.enable.dictionary", "false")
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
