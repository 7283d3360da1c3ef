"""Status updates that rewrite only the partitions they touch.

The keys find the partitions by a semi join on the partition columns and the key alone; the
rest of the record is read in those partitions only. They are written anew and all others
keep their files (see ``sources.snapshots``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siltworks.operators.joins import is_in, not_in
from siltworks.operators.status import apply_status, merge_status
from siltworks.sources.snapshots import current_snapshot, partition_columns, replace_partitions
from siltworks.staging import passing


def _narrow(spark: SparkSession, name: str, on: str) -> DataFrame:
    current = current_snapshot(spark, name)
    if current is None:
        raise ValueError(f"{name} is not a published name")
    return spark.read.table(current).select(*partition_columns(spark, current), on)


def update_partitions(
    spark: SparkSession,
    name: str,
    base: str,
    keys: DataFrame,
    status: str,
    on: str = "value",
    negate: bool = False,
    keep: int | None = None,
) -> list:
    """Set ``status`` on the rows whose ``on`` is among ``keys``, or is not when ``negate``.

    The rules for nulls are those of ``apply_status``. Running an update again changes nothing
    more. Returns the partitions rewritten.
    """
    with passing(spark):
        narrow = _narrow(spark, name, on)
        touched = not_in(narrow, on, keys) if negate else is_in(narrow, on, keys)
        return replace_partitions(
            spark, name, base, touched, lambda rows: apply_status(rows, keys, status, on, negate), keep
        )


def merge_partitions(
    spark: SparkSession, name: str, base: str, updates: DataFrame, on: str, keep: int | None = None
) -> list:
    """Take the status of the ``updates`` row with the same ``on``; see ``merge_status``.

    A partition in which no row has a key of ``updates`` is not touched.
    """
    with passing(spark):
        touched = is_in(_narrow(spark, name, on), on, updates)
        return replace_partitions(
            spark, name, base, touched, lambda rows: merge_status(rows, updates, on), keep
        )
