"""Columns and batches common to the operators."""

from __future__ import annotations

import os
from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def without(df: DataFrame, names: Iterable[str]) -> list[str]:
    """Columns of ``df`` except those named, whatever their case.

    An operator's own columns replace columns of the input that are called the same.
    """
    taken = {name.lower() for name in names}
    return [name for name in df.columns if name.lower() not in taken]


def remainder(key: str, modulus: int) -> Column:
    """crc32 of the key as text, modulo ``modulus``; a null key counts as empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % modulus


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def binary_texts(batch: pa.RecordBatch, column: str) -> list[bytes | None]:
    return batch.column(batch.schema.get_field_index(column)).cast(pa.binary()).to_pylist()


def extended(
    batch: pa.RecordBatch, added: Sequence[tuple[str, pa.Array]], drop: Iterable[str] = ()
) -> pa.RecordBatch:
    """The batch with further columns, and without some of its own."""
    drop = set(drop)
    kept = [(n, batch.column(i)) for i, n in enumerate(batch.schema.names) if n not in drop]
    names, arrays = zip(*kept, *added)
    return pa.RecordBatch.from_arrays(list(arrays), names=list(names))


def one_thread() -> None:
    """Spark runs a task per core, so libraries in a task get one thread."""
    os.environ.setdefault("RAYON_NUM_THREADS", "1")
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
