"""Session settings the operators are written for."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# The joins here carry no broadcast hints on data-sized inputs: Catalyst picks a
# broadcast from the sizes of plainly written files, and adaptive execution splits hot keys of the
# joins that stay sort-merge.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.caseSensitive": "false",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int | str = 8, name: str = "siltworks", **extra: str) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return with_shared_folder(builder.getOrCreate())


_own_folders: list[tempfile.TemporaryDirectory] = []


def with_shared_folder(spark: SparkSession) -> SparkSession:
    """Give a session on one machine a folder for staged tables, where it names none.

    Driver and tasks are one process there. A cluster's sessions are left as they are.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named and re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        _own_folders.append(tempfile.TemporaryDirectory(prefix="siltworks-"))
        context.setCheckpointDir(_own_folders[-1].name)
    return spark


BYTES_PER_TASK = 128 << 20


def sized_session(
    spark: SparkSession, input_bytes: int, bytes_per_task: int = BYTES_PER_TASK
) -> SparkSession:
    """A session with enough shuffle partitions for an input; the given one stays as it is.

    Adaptive execution merges partitions that turn out small but cannot make more of
    them, so a session's default is too few for a large input. The number never falls
    below that default. ``input_bytes`` is the size of the values: multiply the size of
    compressed files by what they expand to. The new session has the settings and the
    catalog of the given one; its current database and temporary views are its own.
    """
    name = "spark.sql.shuffle.partitions"
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if own.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set(name, str(max(-(-input_bytes // bytes_per_task), int(spark.conf.get(name)))))
    return own


@contextmanager
def open_files(spark: SparkSession, files: int) -> Iterator[None]:
    """For a block's writes by partition, let a task keep up to ``files`` files open.

    It then writes rows as they come. Spark's default is to sort all rows of a task by
    partition first, which takes memory, and disk, for all of them. Values beyond ``files`` are still
    sorted, so the number bounds the writers' buffers and not the values.
    """
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(files))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)
