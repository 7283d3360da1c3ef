"""Surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltworks.functions.identity import row_key
from siltworks.staging import settle

# monotonically_increasing_id() holds the partition above this many row bits.
_ROW_BITS = 33


def placed_rows(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """Rows written in ordered ranges, with their ``_slice`` and ``_position`` within it.

    Rows that are equal in ``order`` are told apart by their place in the input, so
    that many of them do not end up in one slice. Spark samples the order columns to
    find the ranges, so they should be narrow.
    """
    place = F.col("_place")
    return settle(
        df.withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(*order, "_tie")
        .sortWithinPartitions(*order, "_tie")
        .drop("_tie")
        .withColumn("_place", F.monotonically_increasing_id())
        .select(
            F.shiftright(place, _ROW_BITS).alias("_slice"),
            place.bitwiseAND((1 << _ROW_BITS) - 1).alias("_position"),
            *df.columns,
        ),
        "placed",
    )


def dense_key(
    df: DataFrame,
    key: str,
    order_by: Sequence[str],
    replayable: bool = False,
) -> DataFrame:
    """Number all rows 1..n in ascending order, nulls first, as a leading long column.

    A hash of the remaining columns breaks ties, so that in effect only exact copies
    are interchangeable and the ids repeat from run to run.

    Rows are range-partitioned, sorted within partitions and written with their
    position. The offset of each partition is then a running sum over one count
    per partition. No task sees more than its own range, and a hot order value,
    or a record with many copies, is spread over several ranges by the tie-breaks.

    ``replayable`` says that ``df`` reads its rows in the same order each time, as
    a scan with projections, filters and generators does; otherwise it is written
    out first, for the last tie-break to be the same when a lost task runs again.
    """
    columns = df.columns
    named = {name.lower() for name in order_by}
    rest = [c for c in columns if c.lower() not in named]
    order = [F.col(name) for name in order_by] + ([row_key(*rest)] if rest else [])
    if not replayable:
        df = settle(df, "unnumbered")
    placed = placed_rows(df, order)
    counts = placed.groupBy("_slice").agg(F.count("*").alias("_rows"))
    # One row per partition of the sort above, so this order fits one task and
    # the offsets fit a broadcast whatever the number of rows.
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_slice", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")
    )
    return placed.join(F.broadcast(offsets), "_slice").select(
        (F.col("_offset") + F.col("_position") + 1).alias(key), *columns
    )


def extend_keys(known: DataFrame, values: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """A keyed dimension with the values it lacks; those it has keep their keys.

    ``known`` is a written table with each value once; its columns other than ``key`` are the
    value, and ``values`` holds them, copies allowed. New values continue after the largest key in
    ascending order, nulls first, as :func:`dense_key` numbers them; without known values they
    start at 1. Nulls are equal, so a null value gets one key, the first time it is seen.
    """
    columns = [name for name in known.columns if name.lower() != key.lower()]
    seen = known.select(*(F.col(name).alias(f"_{name}") for name in columns))
    same = reduce(and_, (F.col(name).eqNullSafe(F.col(f"_{name}")) for name in columns))
    fresh = values.select(*columns).distinct().join(seen, same, "left_anti")
    last = known.agg(F.coalesce(F.max(key), F.lit(0))).scalar()
    numbered = dense_key(fresh, key, order_by).withColumn(key, F.col(key) + last)
    return known.unionByName(numbered.select(known.columns))


def sparse_key(df: DataFrame, key: str) -> DataFrame:
    """Add a leading unique id with gaps, without a shuffle."""
    return df.select(F.monotonically_increasing_id().alias(key), "*")
