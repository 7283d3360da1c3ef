"""Key replacement and membership joins.

The build side of each join is pre-aggregated to one row per key and written plainly
first, unless the caller passes a table already. Catalyst then knows its
size: small, it is broadcast and the wide side is not shuffled; beyond
``spark.sql.autoBroadcastJoinThreshold`` the join is sort-merge, and adaptive
execution splits the partitions that hot keys of the wide side fill.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.staging import settle


def _key_set(keys: DataFrame, column: str) -> DataFrame:
    return settle(keys.select(F.col(column).alias("_key")).distinct(), "keys", plain=True)


def is_in(
    df: DataFrame,
    column: str,
    keys: DataFrame,
    key_column: str | None = None,
    distinct_keys: bool = False,
) -> DataFrame:
    """SQL ``column IN (SELECT key_column FROM keys)``.

    With ``distinct_keys``, ``keys`` is a written table that holds each key once.
    """
    key_column = key_column or column
    if distinct_keys:
        keys = keys.select(F.col(key_column).alias("_key"))
    else:
        keys = _key_set(keys, key_column)
    return df.join(keys, df[column] == keys["_key"], "left_semi")


def not_in(
    df: DataFrame, column: str, keys: DataFrame, key_column: str | None = None
) -> DataFrame:
    """SQL ``column NOT IN (SELECT key_column FROM keys)``, with its rules for null.

    A null key admits no row, and a null in ``column`` is admitted only when there
    are no keys at all. Both are looked up once, so that the join itself is a plain
    anti join, not one that has to broadcast every key.
    """
    keys = _key_set(keys, key_column or column)
    null_keys = keys.agg(F.count_if(F.col("_key").isNull())).scalar()
    key_count = keys.agg(F.count("*")).scalar()
    candidates = df.filter(null_keys == 0).filter(df[column].isNotNull() | (key_count == 0))
    return candidates.join(keys, candidates[column] == keys["_key"], "left_anti")


def replace_with_key(
    df: DataFrame,
    column: str,
    dimension: DataFrame,
    natural: str,
    key: str,
    drop: Sequence[str] = (),
) -> DataFrame:
    """Replace a natural value by its dimension key, in place.

    Rows whose value is null or not in the dimension disappear. ``dimension`` holds each
    natural value once. Its values and keys are written plainly first, so that a dimension
    that compresses well is not taken for a small one.
    """
    lookup = settle(
        dimension.select(F.col(natural).alias("_natural"), F.col(key).alias("_key")),
        "lookup",
        plain=True,
    )
    return (
        df.join(lookup, df[column] == lookup["_natural"], "inner")
        .withColumn(column, F.col("_key"))
        .drop("_natural", "_key", *drop)
    )


def join_using(df: DataFrame, other: DataFrame, *columns: str, plain: bool = True) -> DataFrame:
    """Inner join on shared columns, which appear once.

    ``other`` is the smaller side and is written plainly first; not ``plain``, it is joined as
    it is, for a table that is large anyway or plainly written.
    """
    side = settle(other, "side", plain=True) if plain else other
    return df.join(side, list(columns), "inner")
