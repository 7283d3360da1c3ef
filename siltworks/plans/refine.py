"""Bronze to silver: dimensions, bridge, silver records and the final load status.

Each result is a function of the bronze rows. Classification looks at one record
at a time, so every copy of a record gets the same outcome and no result has to be
read back to find the status of a row. Only the copies of unrepairable records are
counted, since all other records end as loaded anyway.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from siltworks.operators import rules
from siltworks.operators.columns import add_metadata, expand_struct, explode_column
from siltworks.operators.distinct import append_all, distinct_records, duplicates
from siltworks.operators.filters import non_blank
from siltworks.operators.joins import replace_with_key
from siltworks.operators.keys import dense_key
from siltworks.operators.status import LOADED, QUARANTINED, apply_status
from siltworks.plans.checks import ObservedState
from siltworks.plans.spec import Spec
from siltworks.session import sized_session
from siltworks.sources.documents import read_landing
from siltworks.sources.files import inventory
from siltworks.sources.snapshots import publish_swap
from siltworks.sources.tables import ensure_database, publish
from siltworks.staging import passing, settle


def bronze_rows(documents: DataFrame, array: str, spec: Spec, datasource: str) -> DataFrame:
    """One new bronze row per element of the documents' arrays; copies are kept."""
    return add_metadata(explode_column(documents, array, spec.record), datasource)


def tag_dimension(bronze: DataFrame, spec: Spec) -> DataFrame:
    """Distinct tags with a name."""
    tags = explode_column(bronze, f"{spec.record}.{spec.tags}", "tag")
    return non_blank(expand_struct(tags, "tag", keep=False), spec.tag_name).distinct()


def bridge(bronze: DataFrame, spec: Spec) -> DataFrame:
    """Keyed pairs of record and tag, one per tag of every bronze row.

    ``bronze`` is a written table.
    """
    record_id = F.col(f"{spec.record}.{spec.identifier}").alias(spec.bridge_record_id)
    pairs = explode_column(bronze, f"{spec.record}.{spec.tags}", "tag", [record_id]).select(
        spec.bridge_record_id, F.col(f"tag.{spec.tag_id}").alias(spec.bridge_tag_id)
    )
    order = [spec.bridge_record_id, spec.bridge_tag_id]
    return dense_key(pairs, spec.bridge_key, order, replayable=True)


def attribute_dimension(bronze: DataFrame, spec: Spec) -> DataFrame:
    """Keyed distinct attribute values; a null value has a key too, the first."""
    values = bronze.select(
        F.col(f"{spec.record}.{spec.attribute}").alias(spec.attribute_name)
    ).distinct()
    return dense_key(values, spec.attribute_key, [spec.attribute_name])


def classified(bronze: DataFrame, spec: Spec) -> DataFrame:
    """Bronze rows with their outcome, which is null where there is no record.

    The attribute dimension is made of all bronze rows, so an attribute finds its
    key exactly where it is not null.
    """
    rows = rules.classify(bronze, spec.rules, [spec.attribute], prefix=f"{spec.record}.")
    return rows.withColumn(
        "outcome", F.when(F.col(spec.record).isNotNull(), F.col("outcome"))
    )


def first_status(bronze: DataFrame, spec: Spec) -> DataFrame:
    """Load status before repair: clean records are loaded, all others quarantined."""
    status = F.when(F.col("outcome") == rules.CLEAN, LOADED).when(
        F.col("outcome").isNotNull(), QUARANTINED
    )
    return (
        classified(bronze, spec)
        .withColumn("status", F.coalesce(status, F.col("status")))
        .drop("outcome")
    )


def loadable(bronze: DataFrame, attributes: DataFrame, spec: Spec) -> DataFrame:
    """Clean and repaired records in silver columns, with their copies.

    ``attributes`` is the written attribute dimension.
    """
    fields = expand_struct(bronze, spec.record, keep=False)
    kept = fields.filter(rules.loadable(spec.rules, [spec.attribute]))
    return replace_with_key(
        rules.repair(kept, spec.rules),
        spec.attribute,
        attributes,
        spec.attribute_name,
        spec.attribute_key,
        drop=[spec.tags],
    )


def silver(bronze: DataFrame, attributes: DataFrame, spec: Spec) -> DataFrame:
    """Distinct loadable records. Rows that differ only in tags, or before repair, become one."""
    return distinct_records(loadable(bronze, attributes, spec))


def final_status(bronze: DataFrame, spec: Spec) -> DataFrame:
    """Bronze rows with their status after repair and duplicate handling.

    Loadable records are loaded. The copies of a repeated record end as loaded even
    when it could not be repaired; a single unrepairable record stays quarantined.
    Rows without a record keep the status they have.
    """
    fields = f"{spec.record}."
    no_record = F.col(spec.record).isNull()
    loaded = bronze.filter(
        no_record | rules.loadable(spec.rules, [spec.attribute], fields)
    ).withColumn("status", F.when(no_record, F.col("status")).otherwise(LOADED))
    # Written out, so that the whole records of bronze are not scanned once to find
    # the repeated ones and once more to mark them.
    stuck = settle(
        bronze.filter(~no_record & rules.unrepairable(spec.rules, [spec.attribute], fields)),
        "stuck",
    ).withColumn("status", F.lit(QUARANTINED))
    repeated = duplicates(stuck, spec.record)
    return append_all(loaded, apply_status(stuck, repeated, LOADED, on=spec.record))


def unreadable(documents: DataFrame, array: str, corrupt_column: str) -> DataFrame:
    """Documents that gave no array at all: their file and, if it could not be parsed, their text."""
    return documents.filter(F.col(array).isNull()).select(
        F.col("_metadata.file_path").alias("path"), F.col(corrupt_column).alias("text")
    )


def _with_text(schema: StructType | str, column: str) -> StructType | str:
    if isinstance(schema, str):
        return f"{schema.rstrip()}, `{column}` string"
    return StructType([*schema.fields, StructField(column, StringType())])


def refine(
    spark: SparkSession,
    landing: str,
    root: str,
    database: str,
    spec: Spec,
    schema: StructType | str,
    array: str,
    datasource: str,
    name_glob: str = "*",
    multi_line: bool = True,
    fmt: str = "parquet",
    mode: str = "PERMISSIVE",
    corrupt_column: str = "_unparsed",
    keep_snapshots: int = 2,
    expansion: float = 1.0,
    state: ObservedState | None = None,
) -> dict[str, str]:
    """Load a landing folder into a database of bronze and silver tables.

    A full refresh: the tables are replaced, not extended, and the last ``keep_snapshots``
    of each stay on storage. Returns the qualified table names by role. Bronze as it
    arrives is staged; every table is published once. Documents without the array, such as
    those that cannot be parsed, are in the table ``unreadable``; with ``mode="FAILFAST"``
    they fail the load. ``expansion`` is what compressed documents expand to. ``state`` takes the
    counts of the end-state checks as the tables are written.
    """
    # Dropping a database clears its own folder, so that holds no table.
    ensure_database(spark, database, f"{root.rstrip('/')}/database")
    tables = {role: f"{database}.{name}" for role, name in spec.tables.items()}
    paths = {role: f"{root.rstrip('/')}/{name}" for role, name in spec.tables.items()}
    found = inventory(spark, landing, name_glob, recursive=False)
    size = found.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    own = sized_session(spark, int(size * expansion))
    text = corrupt_column if mode.upper() == "PERMISSIVE" else None
    wanted = _with_text(schema, corrupt_column) if text else schema
    documents = read_landing(
        own, landing, wanted, name_glob, multi_line=multi_line, mode=mode, corrupt_column=text
    )
    if not text:
        documents = documents.withColumn(corrupt_column, F.lit(None).cast("string"))

    def save(df: DataFrame, role: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
        # A catalog keeps a location per partition, so a partitioned table changes over as a view.
        sink = publish_swap if partition_by else publish
        df = state.watch(df, role) if state else df
        sink(df, tables[role], paths[role], fmt, partition_by, keep_snapshots)
        return own.read.table(tables[role])

    with passing(own):
        bronze = settle(bronze_rows(documents, array, spec, datasource), "bronze")
        save(unreadable(documents, array, corrupt_column), "unreadable")
        save(tag_dimension(bronze, spec), "tag")
        save(bridge(bronze, spec), "bridge")
        attributes = save(attribute_dimension(bronze, spec), "attribute")
        save(silver(bronze, attributes, spec), "silver")
        save(final_status(bronze, spec), "bronze", ("ingestdate",))
    return tables
