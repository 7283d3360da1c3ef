"""Quality rules: classification and repair of records in one pass."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CLEAN = "clean"
REPAIRABLE = "repairable"
UNREPAIRABLE = "unrepairable"


@dataclass(frozen=True)
class Rule:
    """A test of one column and the value that mends a failure.

    A null never passes. It cannot be mended either, unless ``null_repairable``:
    such a record is then loaded with the null.
    """

    name: str
    column: str
    passes: Callable[[Column], Column]
    mend: Callable[[Column], Column]
    null_repairable: bool = False


def at_least(
    name: str,
    column: str,
    minimum: float,
    mend: Callable[[Column], Column],
    null_repairable: bool = False,
) -> Rule:
    """The rule that a column is not below ``minimum``."""
    return Rule(name, column, lambda c: c >= minimum, mend, null_repairable)


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(and_, conditions, F.lit(True))


def loadable(rules: Sequence[Rule], required: Sequence[str] = (), prefix: str = "") -> Column:
    """Whether a record is clean or can be made so, as null tests that reach the scan."""
    needed = [*required, *[rule.column for rule in rules if not rule.null_repairable]]
    return _all([F.col(prefix + name).isNotNull() for name in needed])


def unrepairable(rules: Sequence[Rule], required: Sequence[str] = (), prefix: str = "") -> Column:
    """The opposite of :func:`loadable`."""
    return ~loadable(rules, required, prefix)


def outcome(rules: Sequence[Rule], required: Sequence[str] = (), prefix: str = "") -> Column:
    """Clean, repairable or unrepairable, for a record whose fields start with ``prefix``.

    A record without a value in a ``required`` field is unrepairable.
    """
    passing = [F.coalesce(rule.passes(F.col(prefix + rule.column)), F.lit(False)) for rule in rules]
    can_load = loadable(rules, required, prefix)
    return (
        F.when(_all([can_load, *passing]), CLEAN)
        .when(can_load, REPAIRABLE)
        .otherwise(UNREPAIRABLE)
    )


def classify(
    df: DataFrame,
    rules: Sequence[Rule],
    required: Sequence[str] = (),
    prefix: str = "",
    name: str = "outcome",
) -> DataFrame:
    """Add the outcome of the rules as a column."""
    return df.withColumn(name, outcome(rules, required, prefix))


def repair(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Mend the failing columns; passing and null values stay."""
    mended = {
        rule.column: F.when(~rule.passes(F.col(rule.column)), rule.mend(F.col(rule.column)))
        .otherwise(F.col(rule.column))
        for rule in rules
    }
    return df.withColumns(mended)
