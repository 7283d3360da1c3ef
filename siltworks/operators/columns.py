"""Projections and generators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def add_metadata(df: DataFrame, datasource: str, status: str = "new") -> DataFrame:
    """Add source name, ingest time, load status and ingest date, or replace them."""
    return df.withColumns(
        {
            "datasource": F.lit(datasource),
            "ingesttime": F.current_timestamp(),
            "status": F.lit(status),
            "ingestdate": F.current_date(),
        }
    )


def expand_struct(df: DataFrame, column: str, keep: bool = True) -> DataFrame:
    """The fields of a struct as columns, after the struct itself when ``keep``."""
    return df.select(*([column] if keep else []), f"{column}.*")


def explode_column(
    df: DataFrame, column: str, alias: str, carry: Sequence[str | Column] = ()
) -> DataFrame:
    """One row per array element, with ``carry`` repeated; empty and null arrays give none."""
    return df.select(*carry, F.explode(column).alias(alias))


def explode_in_place(df: DataFrame, column: str) -> DataFrame:
    """Replace an array column by its elements, one row each."""
    return df.withColumn(column, F.explode(column))


def replace_column(df: DataFrame, column: str, value: Column) -> DataFrame:
    """Replace a column at its position; the type may change."""
    return df.withColumn(column, value)


def drop_columns(df: DataFrame, *columns: str) -> DataFrame:
    """Drop columns by name, passing over names that do not exist."""
    return df.drop(*columns)
