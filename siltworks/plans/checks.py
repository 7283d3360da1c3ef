"""End-state checks."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from siltworks.operators.status import LOADED
from siltworks.plans.spec import Spec


def count_checks(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """The number of rows meeting each condition, as one row per check, from one scan."""
    counted = df.agg(*[F.count_if(condition).alias(name) for name, condition in checks.items()])
    return counted.unpivot([], list(checks), "check", "rows")


def state_checks(spec: Spec) -> dict[str, dict[str, Column]]:
    """The conditions counted in the tables of a finished load, by role; see :func:`end_state`."""
    always = F.lit(True)
    failing = {
        f"{rule.name}_failing": ~rule.passes(F.col(rule.column)) for rule in spec.rules
    }
    unknown = {f"{rule.name}_null": F.col(rule.column).isNull() for rule in spec.rules}
    record = F.col(spec.record)
    unclassified = [F.col(f"{spec.record}.{rule.column}").isNull() for rule in spec.rules]
    return {
        "silver": {"silver_rows": always, **failing, **unknown},
        "bronze": {
            "bronze_rows": always,
            "not_loaded": F.col("status") != LOADED,
            "null_unclassified": record.isNotNull() & reduce(or_, unclassified),
            "missing_attribute": record.isNotNull()
            & F.col(f"{spec.record}.{spec.attribute}").isNull(),
        },
        "tag": {"tag_rows": always, "blank_tag_name": F.col(spec.tag_name) == ""},
        "unreadable": {"unreadable_documents": always},
    }


def end_state(
    bronze: DataFrame,
    silver: DataFrame,
    tags: DataFrame,
    spec: Spec,
    unreadable: DataFrame | None = None,
) -> DataFrame:
    """Counts that describe a finished load, one row per check.

    Violations are the rows not loaded, the silver rows failing a rule, and blank
    tag names. What a comparison cannot see is counted next to them: nulls in a
    rule's column, in silver and in bronze, records without an attribute, and, where the
    load kept them, documents that could not be read.
    """
    checks = state_checks(spec)
    counts = count_checks(silver, checks["silver"])
    counts = counts.unionByName(count_checks(bronze, checks["bronze"]))
    counts = counts.unionByName(count_checks(tags, checks["tag"]))
    if unreadable is not None:
        counts = counts.unionByName(count_checks(unreadable, checks["unreadable"]))
    return counts


class ObservedState:
    """The counts of :func:`end_state`, taken while the tables are written.

    A frame given to :meth:`watch` must then be written, once; its counts come with that job, and
    :meth:`counts` reads no table.
    """

    def __init__(self, spec: Spec):
        self._checks = state_checks(spec)
        self._observed: dict[str, Observation] = {}

    def watch(self, df: DataFrame, role: str) -> DataFrame:
        """The same rows, counted as they pass; tables without checks are left as they are."""
        if role not in self._checks:
            return df
        self._observed[role] = Observation(f"checks of {role}")
        counted = [F.count_if(value).alias(name) for name, value in self._checks[role].items()]
        return df.observe(self._observed[role], *counted)

    def counts(self, spark: SparkSession) -> DataFrame:
        """One row per check of the tables that were written."""
        rows = [
            (name, self._observed[role].get.get(name, 0))
            for role in self._checks
            if role in self._observed
            for name in self._checks[role]
        ]
        return spark.createDataFrame(rows, "check string, rows long")


def violations(counts: DataFrame, spec: Spec) -> DataFrame:
    """The checks of :func:`end_state` that a finished load must have at zero, and has not."""
    must_be_zero = ["not_loaded", "blank_tag_name", "unreadable_documents", *[f"{rule.name}_failing" for rule in spec.rules]]
    return counts.filter(F.col("check").isin(must_be_zero) & (F.col("rows") > 0))
