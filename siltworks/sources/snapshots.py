"""Tables whose content changes over in one catalog step, and of which parts can be replaced.

A published name is a view of one snapshot, a table of its own. A new snapshot is complete, with
all its partitions in the catalog, before one ``ALTER VIEW`` points the name at it, so a reader
sees the old content or the new one and never misses the table. A snapshot that replaces some
partitions takes over the files of all others: their locations are entered again, not copied.

One writer at a time. Queries that started on an older snapshot keep its files until it expires.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.sources.tables import register_table, write_table
from siltworks.staging import delete_folder

# Partitions that one statement enters in the catalog.
PARTITIONS_AT_ONCE = 200
# Fixed value: the folder name that stands for a null partition value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"

Spec = tuple[tuple[str, str], ...]


def _quoted(name: str) -> str:
    return ".".join(f"`{part.replace('`', '``')}`" for part in name.split("."))


def _literal(value: str) -> str:
    if value == NULL_PARTITION:
        return "NULL"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _catalog(spark: SparkSession, name: str):
    """The session's catalog, and a table's name for it. It answers without a Spark job."""
    state = spark._jsparkSession.sessionState()
    return state.catalog(), state.sqlParser().parseTableIdentifier(_quoted(name))


def _described(spark: SparkSession, name: str):
    """What the catalog holds on a table or view, or None if there is none."""
    catalog, identifier = _catalog(spark, name)
    return catalog.getTableMetadata(identifier) if catalog.tableExists(identifier) else None


def _path(spark: SparkSession, uri) -> str:
    """A location as a path; the text of its URI would be escaped once more."""
    return re.sub("^file:/+", "/", spark._jvm.org.apache.hadoop.fs.Path(uri).toString())


def current_snapshot(spark: SparkSession, name: str) -> str | None:
    """The snapshot table that a published name shows, or None if there is no such name."""
    found = _described(spark, name)
    if found is None or found.tableType().name() != "VIEW":
        return None
    return re.fullmatch(r"SELECT \* FROM (.*)", found.viewText().get()).group(1).replace("`", "")


def snapshots(spark: SparkSession, name: str) -> list[str]:
    """The snapshot tables of a published name that are still there, oldest first."""
    database, _, own = name.rpartition(".")
    own_prefix = f"{own}__snapshot_".lower()
    scope = database or spark.catalog.currentDatabase()
    rows = spark.sql(f"SHOW TABLES IN {_quoted(scope)} LIKE '{own.replace('*', '')}__snapshot_*'").collect()
    found = sorted(row["tableName"] for row in rows if row["tableName"].lower().startswith(own_prefix))
    return [f"{database}.{table}" if database else table for table in found]


def _fresh(name: str, base: str) -> tuple[str, str]:
    label = f"{time.time_ns():020d}_{uuid.uuid4().hex[:8]}"
    return f"{name}__snapshot_{label}", f"{base.rstrip('/')}/snapshot-{label}"


def _point(spark: SparkSession, name: str, snapshot: str) -> None:
    """Show a snapshot under the published name."""
    if current_snapshot(spark, name) is not None:
        spark.sql(f"ALTER VIEW {_quoted(name)} AS SELECT * FROM {_quoted(snapshot)}")
        return
    # The name's first snapshot; a plain table of that name makes way for it.
    spark.sql(f"DROP TABLE IF EXISTS {_quoted(name)}")
    spark.sql(f"CREATE VIEW {_quoted(name)} AS SELECT * FROM {_quoted(snapshot)}")


def publish_swap(
    df: DataFrame,
    name: str,
    base: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    keep: int | None = None,
) -> str:
    """Write ``df`` as a new snapshot below ``base`` and show it under ``name``.

    ``df`` may read ``name`` itself. Columns, partitioning and format may differ from those of the
    snapshot before. With ``keep``, older snapshots than the last ``keep`` go. Returns the name of
    the snapshot's table, by which it can be read as long as it is kept.
    """
    spark = df.sparkSession
    snapshot, path = _fresh(name, base)
    write_table(df, path, mode="errorifexists", fmt=fmt, partition_by=partition_by)
    register_table(spark, snapshot, path, fmt, schema=df.schema, partition_by=partition_by)
    _point(spark, name, snapshot)
    if keep is not None:
        expire(spark, name, keep)
    return snapshot


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    names = _described(spark, table).partitionColumnNames()
    return [names.apply(i) for i in range(names.size())]


def partition_locations(spark: SparkSession, table: str) -> dict[Spec, str]:
    """Where the files of each partition of a table lie, as the catalog has it."""
    catalog, identifier = _catalog(spark, table)
    names = partition_columns(spark, table)
    found, rows = {}, catalog.listPartitions(identifier, spark._jvm.scala.Option.empty())
    for i in range(rows.size()):
        partition = rows.apply(i)
        spec = partition.spec()
        found[tuple((name, spec.apply(name)) for name in names)] = _path(spark, partition.location())
    return found


def _enter(spark: SparkSession, table: str, locations: dict[Spec, str]) -> None:
    items = list(locations.items())
    for at in range(0, len(items), PARTITIONS_AT_ONCE):
        clauses = " ".join(
            "PARTITION ("
            + ", ".join(f"{_quoted(name)} = {_literal(value)}" for name, value in spec)
            + f") LOCATION {_literal(location)}"
            for spec, location in items[at : at + PARTITIONS_AT_ONCE]
        )
        spark.sql(f"ALTER TABLE {_quoted(table)} ADD {clauses}")


def _in_partitions(partitions: Sequence, names: Sequence[str]) -> Column:
    """Whether a row lies in one of some partitions, as a filter that prunes all others."""
    if len(names) == 1:
        values = [row[0] for row in partitions if row[0] is not None]
        found = F.col(names[0]).isin(values)
        return found | F.col(names[0]).isNull() if len(values) < len(partitions) else found
    return reduce(or_, (reduce(and_, (F.col(n).eqNullSafe(F.lit(v)) for n, v in zip(names, row))) for row in partitions))


def replace_partitions(
    spark: SparkSession,
    name: str,
    base: str,
    touched: DataFrame,
    change: Callable[[DataFrame], DataFrame],
    keep: int | None = None,
) -> list:
    """Show ``name`` with some of its partitions changed and the files of all others as they are.

    ``touched`` holds partition values; they come to the driver, which has the partitions of the
    catalog anyway. ``change`` gets the rows of those partitions alone, read with the others
    pruned, and returns rows of the same columns, in the same partitions. A partition that is
    left without rows goes. Returns the partitions changed; without any, nothing is written.
    """
    current = current_snapshot(spark, name)
    if current is None:
        raise ValueError(f"{name} is not a published name")
    names = partition_columns(spark, current)
    if not names:
        raise ValueError(f"{name} has no partitions")
    partitions = touched.select(*names).distinct().collect()
    if not partitions:
        return []
    rows = spark.read.table(current)
    changed = change(rows.filter(_in_partitions(partitions, names))).select(*rows.columns)
    fmt = _described(spark, current).provider().get()
    snapshot, path = _fresh(name, base)
    write_table(changed, path, mode="errorifexists", fmt=fmt, partition_by=names)
    register_table(spark, snapshot, path, fmt, schema=rows.schema, partition_by=names)
    texts = {tuple(_text(value) for value in row) for row in _as_text(spark, partitions, rows, names)}
    others = {
        spec: location
        for spec, location in partition_locations(spark, current).items()
        if tuple(value for _, value in spec) not in texts
    }
    outside = set(partition_locations(spark, snapshot)) & set(others)
    if outside:
        spark.sql(f"DROP TABLE {_quoted(snapshot)}")
        delete_folder(spark, path)
        raise ValueError(f"rows moved to partitions that were not to change: {sorted(outside)[:3]}")
    _enter(spark, snapshot, others)
    _point(spark, name, snapshot)
    if keep is not None:
        expire(spark, name, keep)
    return partitions


def add_partitions(
    df: DataFrame,
    name: str,
    base: str,
    partition_by: Sequence[str],
    fmt: str = "parquet",
    keep: int | None = None,
) -> str:
    """Show ``name`` with the partitions of ``df``; all others keep their files.

    Partitions that are there already are replaced, so a load that runs again leaves its rows once.
    Without such a name, it is published. Returns the name of the snapshot's table.
    """
    spark = df.sparkSession
    current = current_snapshot(spark, name)
    if current is None:
        return publish_swap(df, name, base, fmt, partition_by, keep)
    snapshot, path = _fresh(name, base)
    write_table(df, path, mode="errorifexists", fmt=fmt, partition_by=partition_by)
    register_table(spark, snapshot, path, fmt, schema=df.schema, partition_by=partition_by)
    own = partition_locations(spark, snapshot)
    before = partition_locations(spark, current)
    _enter(spark, snapshot, {spec: place for spec, place in before.items() if spec not in own})
    _point(spark, name, snapshot)
    if keep is not None:
        expire(spark, name, keep)
    return snapshot


def _text(value: str | None) -> str:
    return NULL_PARTITION if value in (None, "") else value


def _as_text(spark: SparkSession, partitions: Sequence, rows: DataFrame, names: Sequence[str]) -> list:
    """Partition values as the catalog spells them."""
    schema = rows.select(*names).schema
    frame = spark.createDataFrame(partitions, schema)
    return frame.select(*(F.col(name).cast("string") for name in names)).collect()


def expire(spark: SparkSession, name: str, keep: int) -> list[str]:
    """Drop all but the last ``keep`` snapshots; the one shown always stays.

    Folders that a later snapshot has taken over stay with it. Returns the tables dropped.
    """
    shown = current_snapshot(spark, name)
    every = snapshots(spark, name)
    gone = [table for table in every[: -max(keep, 1)] if table != shown]
    if not gone:
        return []
    kept = [table for table in every if table not in gone]
    live = {location for table in kept for location in _locations(spark, table)}
    roots = {_root(location) for location in live}
    for table in gone:
        for location in {*_locations(spark, table), _root_of(spark, table)} - live:
            # The whole snapshot's folder, unless a later one has taken over some of it.
            root = _root(location)
            if root not in roots:
                delete_folder(spark, root)
            elif location != root:
                delete_folder(spark, location)
        spark.sql(f"DROP TABLE {_quoted(table)}")
    return gone


def _root(location: str) -> str:
    """The snapshot folder that a location lies in."""
    found = re.match(r".*?/snapshot-[^/]+", location)
    return found.group(0) if found else location


def _root_of(spark: SparkSession, table: str) -> str:
    return _path(spark, _described(spark, table).location())


def _locations(spark: SparkSession, table: str) -> list[str]:
    """The folders that hold a snapshot's files."""
    if partition_columns(spark, table):
        return list(partition_locations(spark, table).values())
    return [_root_of(spark, table)]
