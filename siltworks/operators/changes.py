"""What changed between two states of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.functions.identity import row_key, second_key
from siltworks.operators.joins import is_in
from siltworks.staging import settle

ADDED = "added"
REMOVED = "removed"
CHANGED = "copies"


def _counted(df: DataFrame, name: str) -> DataFrame:
    """Copies by hash, with a sum of second hashes that tells apart rows whose first are equal."""
    second = second_key(*df.columns).cast("decimal(38, 0)")
    return df.groupBy(row_key(*df.columns).alias("_row_key")).agg(
        F.count("*").alias(name), F.sum(second).alias(f"{name}_sum")
    )


def changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows whose number of copies differs, with the numbers ``before`` and ``after``.

    ``change`` is ``added`` where there was none, ``removed`` where there is none, and ``copies``
    where both have the row. Both sides have the same columns, by name; nulls are equal.

    Both sides are first reduced to hashes with their copies, and compared by a full outer
    join; whole rows are read again, and shuffled, only where those differ.
    """
    columns = before.columns
    after = after.select(*columns)
    old, new = _counted(before, "_before"), _counted(after, "_after")
    same = F.col("_before").eqNullSafe(F.col("_after")) & F.col("_before_sum").eqNullSafe(F.col("_after_sum"))
    differing = settle(old.join(new, "_row_key", "full").filter(~same).select("_row_key"), "differing", plain=True)

    def some(df: DataFrame, was: int) -> DataFrame:
        keyed = df.withColumn("_row_key", row_key(*columns))
        return is_in(keyed, "_row_key", differing, distinct_keys=True).select(
            *columns, F.lit(was).alias("_was")
        )

    counted = (
        some(before, 1)
        .unionByName(some(after, 0))
        .groupBy(*columns)
        .agg(F.sum("_was").alias("before"), F.sum(1 - F.col("_was")).alias("after"))
        .filter("before <> after")
    )
    kind = F.when(F.col("before") == 0, ADDED).when(F.col("after") == 0, REMOVED).otherwise(CHANGED)
    return counted.withColumn("change", kind)
