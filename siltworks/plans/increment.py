"""Refresh by load: only what is new is read, and only what it changes is written anew.

Bronze has a partition per ingest date and load, silver and the bridge one per load. A load brings
its documents, adds its partitions, extends the dimensions without moving a key, and adds
the records that silver lacks. Statuses of earlier rows change in one case only: a single
record that could not be repaired, and now has a copy. A ledger of such records tells the loads
it came in, so just their partitions are rewritten.

Every step replaces what the same load wrote before, and a load counts as finished with its last
step, so a load that broke off is run again from its documents, and one that is finished is
passed over. One load at a time.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.functions.identity import row_key
from siltworks.operators import rules
from siltworks.operators.distinct import append_all
from siltworks.operators.joins import is_in
from siltworks.operators.keys import dense_key, extend_keys
from siltworks.operators.ledger import BUCKETS, remember, remembered
from siltworks.operators.status import LOADED, QUARANTINED, apply_status
from siltworks.plans import refine
from siltworks.plans.spec import Spec
from siltworks.sources.snapshots import add_partitions, current_snapshot, publish_swap, replace_partitions
from siltworks.sources.tables import ensure_database
from siltworks.staging import passing, settle, staged_path

BY_DAY = ["ingestdate", "load"]


class Layers:
    """The tables of a database that is refreshed load by load; ``buckets`` are those of the ledger."""

    def __init__(
        self, spark: SparkSession, root: str, database: str, spec: Spec, keep: int = 2, buckets: int = BUCKETS
    ):
        self.spark, self.spec, self.keep, self.buckets = spark, spec, keep, buckets
        names = {**spec.tables, "progress": "finished_loads", "ledger": "unrepaired_records"}
        self.tables = {role: f"{database}.{name}" for role, name in names.items()}
        self.paths = {role: f"{root.rstrip('/')}/{name}" for role, name in names.items()}
        current = spark.catalog.currentDatabase()
        ensure_database(spark, database, f"{root.rstrip('/')}/database")
        spark.catalog.setCurrentDatabase(current)

    def read(self, role: str) -> DataFrame | None:
        """A table, or None before the first load."""
        if current_snapshot(self.spark, self.tables[role]) is None:
            return None
        return self.spark.read.table(self.tables[role])

    def finished(self) -> set[str]:
        """The names of the loads that are complete."""
        progress = self.read("progress")
        return {row["load"] for row in progress.collect()} if progress is not None else set()

    def part(self, role: str, load: str) -> DataFrame:
        """What one load has added to a table; other partitions are not listed or read."""
        return self.spark.read.table(self.tables[role]).filter(F.col("load") == load)

    def _others(self, role: str, load: str) -> DataFrame | None:
        rows = self.read(role)
        return None if rows is None else rows.filter(F.col("load") != load)

    def _add(self, df: DataFrame, role: str, load: str, by: list[str]) -> None:
        add_partitions(df.withColumn("load", F.lit(load)), self.tables[role], self.paths[role], by, keep=self.keep)

    def _replace(self, df: DataFrame, role: str) -> None:
        publish_swap(df, self.tables[role], self.paths[role], keep=self.keep)

    def run(
        self, documents: DataFrame, load: str, array: str, datasource: str, ingestdate: date | None = None
    ) -> bool:
        """Add a load of documents. Returns False, and does nothing, if it is finished already.

        ``ingestdate`` is today's by default. Tables and their meaning are those of ``refine``
        over all loads together, but that keys are given out load by load, and that silver and
        the bridge have the column ``load``, the first that brought a record. ``documents`` are read
        once, and may be of another session.
        """
        if load in self.finished():
            return False
        with passing(self.spark):
            rows = refine.bronze_rows(documents, array, self.spec, datasource)
            if ingestdate is not None:
                rows = rows.withColumn("ingestdate", F.lit(ingestdate))
            # Read back in the session of the tables; that of the documents may be a batch's own.
            path = staged_path(self.spark, "load")
            rows.write.parquet(path)
            self._bronze(self.spark.read.schema(rows.schema).parquet(path), load)
            new = self.part("bronze", load)
            self._dimensions(new)
            self._bridge(new, load)
            self._silver(new, load)
            day = self.spark.createDataFrame([(load,)], "load string")
            done = self.read("progress")
            self._replace(day if done is None else settle(done.unionByName(day), "progress"), "progress")
        return True

    def _bronze(self, rows: DataFrame, load: str) -> None:
        """Rows with their status, and the status of the earlier rows that they change."""
        spec, fields = self.spec, f"{self.spec.record}."
        no_record = F.col(spec.record).isNull()
        fine = rules.loadable(spec.rules, [spec.attribute], fields)
        ready = rows.filter(no_record | fine).withColumn(
            "status", F.when(no_record, F.col("status")).otherwise(LOADED)
        )
        stuck = settle(rows.filter(~no_record & ~fine), "stuck").withColumn("status", F.lit(QUARANTINED))
        ledger = self.tables["ledger"]
        known = settle(remembered(stuck, spec.record, ledger, load), "known", plain=True)
        repeated = self._records(stuck, known.filter("_copies + _earlier > 1"))
        self._add(append_all(ready, apply_status(stuck, repeated, LOADED, on=spec.record)), "bronze", load, BY_DAY)
        # A single record of one earlier load was quarantined; it has a copy now.
        mended = known.filter("_earlier = 1")
        loads = mended.select(F.explode("_loads").alias("load")).distinct()
        names = [row["load"] for row in loads.collect()]  # some of the loads, not their rows
        if names:
            keys = self._records(stuck, mended)
            touched = self.spark.read.table(self.tables["bronze"]).filter(F.col("load").isin(names))
            replace_partitions(
                self.spark, self.tables["bronze"], self.paths["bronze"], touched.select(*BY_DAY),
                lambda old: apply_status(old, keys, LOADED, on=spec.record), self.keep,
            )
        remember(stuck, spec.record, ledger, self.paths["ledger"], load, self.buckets)

    def _records(self, stuck: DataFrame, known: DataFrame) -> DataFrame:
        keys = settle(known.select("_row_key").distinct(), "keys", plain=True)
        keyed = stuck.select(self.spec.record, row_key(self.spec.record).alias("_row_key"))
        return is_in(keyed, "_row_key", keys, distinct_keys=True).select(self.spec.record)

    def _dimensions(self, new: DataFrame) -> None:
        spec = self.spec
        tags, known = refine.tag_dimension(new, spec), self.read("tag")
        self._replace(tags if known is None else known.unionByName(tags).distinct(), "tag")
        known = self.read("attribute")
        if known is None:
            self._replace(refine.attribute_dimension(new, spec), "attribute")
            return
        values = new.select(F.col(f"{spec.record}.{spec.attribute}").alias(spec.attribute_name))
        self._replace(extend_keys(known, values, spec.attribute_key, [spec.attribute_name]), "attribute")

    def _bridge(self, new: DataFrame, load: str) -> None:
        """Pairs of this load, numbered after those of the others."""
        spec, others = self.spec, self._others("bridge", load)
        pairs = refine.bridge(new, spec)
        if others is not None:
            last = others.agg(F.coalesce(F.max(spec.bridge_key), F.lit(0))).first()[0]
            pairs = pairs.withColumn(spec.bridge_key, F.col(spec.bridge_key) + last)
        self._add(pairs, "bridge", load, ["load"])

    def _silver(self, new: DataFrame, load: str) -> None:
        """Loadable records of this load that silver lacks.

        Silver is compared by hash first; only records whose hash the load has too are read whole.
        """
        spec, others = self.spec, self._others("silver", load)
        records = refine.silver(new, self.read("attribute"), spec)
        if others is not None:
            # Read twice, so written first.
            records = settle(records, "silver")
            columns = records.columns
            hashes = settle(records.select(row_key(*columns).alias("_row_key")).distinct(), "hashes", plain=True)
            keyed = others.select(*columns, row_key(*columns).alias("_row_key"))
            same = is_in(keyed, "_row_key", hashes, distinct_keys=True).select(*columns)
            records = records.subtract(settle(same, "same"))
        self._add(records, "silver", load, ["load"])
