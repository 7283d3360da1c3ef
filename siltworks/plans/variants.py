"""Other layouts: single-occurrence silver, and a bronze table per entity."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.operators.columns import add_metadata
from siltworks.operators.distinct import singletons
from siltworks.operators.filters import where_all
from siltworks.operators.joins import join_using
from siltworks.operators.status import LOADED, NEW, QUARANTINED
from siltworks.sources.tables import ensure_database, publish
from siltworks.staging import passing, settle


def single_occurrence(
    records: DataFrame,
    identifier: str,
    healthy: Sequence[Column | str],
    unfiltered: bool = False,
) -> DataFrame:
    """Records whose identifier has exactly one healthy record, identifier first.

    Only that healthy record is returned. ``unfiltered`` returns all records of the
    identifier, unhealthy ones included. Records without an identifier disappear.
    """
    fit = where_all(records, *healthy, F.col(identifier).isNotNull())
    if unfiltered:
        ids = settle(singletons(fit, identifier).select(identifier), "ids", plain=True)
        return join_using(ids, records, identifier, plain=False)
    # The only record of a group is any of its records, so no join back is needed
    # and an identifier with many records leaves one row per map task.
    rest = [c for c in records.columns if c.lower() != identifier.lower()]
    return (
        fit.groupBy(identifier)
        .agg(F.count("*").alias("_occurrences"), F.any_value(F.struct(*rest)).alias("_rest"))
        .filter("_occurrences < 2")
        .select(identifier, "_rest.*")
    )


def entity_bronze(entity: DataFrame, datasource: str) -> DataFrame:
    """An entity's rows with metadata, ready for a bronze table of its own."""
    return add_metadata(entity, datasource, NEW)


@dataclass(frozen=True)
class Entity:
    """Rows of an entity, what of them is accepted and rejected, and its silver columns."""

    rows: DataFrame
    silver: Sequence[Column | str]
    accepted: Column | None = None
    rejected: Column | None = None


def refine_entities(
    spark: SparkSession,
    entities: dict[str, Entity],
    root: str,
    database: str,
    datasource: str,
    fmt: str = "parquet",
    keep_snapshots: int = 2,
) -> dict[str, str]:
    """Publish ``<entity>_bronze`` with its final status, and ``<entity>_silver``.

    The rows of an entity are staged once with their metadata. Silver are the distinct
    projections of the loaded rows. Returns the qualified table names.
    """
    ensure_database(spark, database, f"{root.rstrip('/')}/database")
    tables = {}

    def save(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> None:
        tables[name] = f"{database}.{name}"
        base = f"{root.rstrip('/')}/{name}"
        publish(df, tables[name], base, fmt, partition_by, keep_snapshots)

    with passing(spark):
        for name, entity in entities.items():
            rows = settle(entity_bronze(entity.rows, datasource), name)
            marked = entity_status(rows, entity.accepted, entity.rejected)
            save(marked, f"{name}_bronze", ("ingestdate",))
            loaded = marked.filter(F.col("status") == LOADED)
            save(loaded.select(*entity.silver).distinct(), f"{name}_silver")
    return tables


def entity_status(
    bronze: DataFrame, accepted: Column | None = None, rejected: Column | None = None
) -> DataFrame:
    """Mark accepted rows loaded and rejected ones quarantined; others keep their status.

    Without conditions every row is accepted.
    """
    accepted = F.lit(True) if accepted is None else accepted
    rejected = F.lit(False) if rejected is None else rejected
    return bronze.withColumn(
        "status",
        F.when(accepted, LOADED).when(rejected, QUARANTINED).otherwise(F.col("status")),
    )
