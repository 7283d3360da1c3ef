"""Load status as a function of the rows, instead of row-level updates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.functions.identity import row_key
from siltworks.staging import settle

NEW = "new"
LOADED = "loaded"
QUARANTINED = "quarantined"


def apply_status(
    df: DataFrame,
    keys: DataFrame,
    status: str | Column,
    on: str = "value",
    negate: bool = False,
) -> DataFrame:
    """Set ``status`` on the rows whose ``on`` is among ``keys``, or is not when ``negate``.

    Follows SQL ``IN`` and ``NOT IN``: a null is never among the keys; with a null
    key nothing is outside them; without keys everything is. Rows are matched on a
    hash of the record and on the record itself.
    """
    new_status = F.lit(status) if isinstance(status, str) else status
    columns = df.columns
    members = settle(
        keys.select(F.col(on).alias("_member")).distinct().withColumn("_key", row_key("_member")),
        "members",
        plain=True,
    )
    keyed = df.withColumn("_row_key", row_key(on))
    known = members.filter(F.col("_member").isNotNull()).withColumn("_matched", F.lit(True))
    marked = keyed.join(
        known,
        (keyed["_row_key"] == known["_key"]) & (keyed[on] == known["_member"]),
        "left",
    )
    if negate:
        null_keys = members.agg(F.count_if(F.col("_member").isNull())).scalar()
        key_count = members.agg(F.count("*")).scalar()
        chosen = (
            F.col("_matched").isNull()
            & (null_keys == 0)
            & (keyed[on].isNotNull() | (key_count == 0))
        )
    else:
        chosen = F.col("_matched").isNotNull()
    return marked.withColumn(
        "status", F.when(chosen, new_status).otherwise(F.col("status"))
    ).select(*columns)


def merge_status(df: DataFrame, updates: DataFrame, on: str) -> DataFrame:
    """Take the status of the ``updates`` row with the same ``on``, where there is one.

    Repeated updates of a key count once; updates that disagree fail the job, as a
    merge whose source matches a row twice does.
    """
    columns = df.columns
    # A null status is a value like any other, hence the wrapping struct.
    wrapped = F.struct("status")
    merged = settle(
        updates.filter(F.col(on).isNotNull())
        .groupBy(F.col(on).alias("_key"))
        .agg(F.min(wrapped).alias("_low"), F.max(wrapped).alias("_high")),
        "updates",
        plain=True,
    )
    disagree = ~F.col("_low").eqNullSafe(F.col("_high"))
    return (
        df.join(merged, df[on] == merged["_key"], "left")
        .withColumn(
            "status",
            F.when(F.col("_key").isNull(), F.col("status"))
            .when(disagree, F.raise_error(F.lit("updates of one key disagree")))
            .otherwise(F.col("_low.status")),
        )
        .select(*columns)
    )


def quarantined(df: DataFrame, record: str = "value") -> DataFrame:
    """Quarantined records, as the struct followed by its fields."""
    return df.filter(F.col("status") == QUARANTINED).select(record, f"{record}.*")
