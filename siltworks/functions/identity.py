"""A narrow key for whole records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_key(*columns: Column | str) -> Column:
    """A 64-bit hash of whole records, equal wherever the records are equal.

    Unequal records may share a key, so compare the records too.
    """
    return F.xxhash64(*columns)


def second_key(*columns: Column | str) -> Column:
    """Another 64-bit hash of whole records, that tells a null from a struct of nulls, and null
    fields by their names, which :func:`row_key` passes over.
    """
    return F.xxhash64(F.to_json(F.struct(*columns)))
