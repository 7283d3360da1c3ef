"""The refinement as a chain of status updates, each rewriting bronze.

Built from the same operators as the one-pass plan, to check that both agree and to
time them against each other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from siltworks.operators import rules
from siltworks.operators.columns import expand_struct
from siltworks.operators.distinct import append_all, duplicates
from siltworks.operators.filters import split_at
from siltworks.operators.joins import replace_with_key
from siltworks.operators.status import LOADED, QUARANTINED, apply_status, quarantined
from siltworks.plans.refine import attribute_dimension
from siltworks.staging import settle
from workload.bronze import MINIMUM_BUDGET, SPEC


def refresh(bronze: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Silver and final bronze."""
    languages = settle(attribute_dimension(bronze, SPEC))

    def keyed(df: DataFrame) -> DataFrame:
        return replace_with_key(
            df, SPEC.attribute, languages, SPEC.attribute_name, SPEC.attribute_key, drop=[SPEC.tags]
        )

    def update(keys: DataFrame, status: str, negate: bool = False) -> DataFrame:
        return settle(apply_status(bronze, keys, status, negate=negate))

    fields = expand_struct(bronze, "value")
    loaded = [keyed(split_at(split_at(fields, "Budget", MINIMUM_BUDGET)[1], "RunTime", 0)[1])]
    bronze = update(loaded[0], LOADED)
    bronze = update(loaded[0], QUARANTINED, negate=True)
    for dirty in split_at(quarantined(bronze), "Budget", MINIMUM_BUDGET):
        loaded.append(keyed(rules.repair(dirty, SPEC.rules)))
        bronze = update(loaded[-1], LOADED)
    repeated = settle(duplicates(bronze, "value"))
    for status in (QUARANTINED, LOADED):
        bronze = update(repeated, status)
    written = [settle(rows.drop("value")) for rows in loaded]
    return settle(append_all(*written).distinct()), bronze
