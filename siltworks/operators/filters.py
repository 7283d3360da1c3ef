"""Row splits and filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def split_at(df: DataFrame, column: str, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Rows below the threshold, and rows at or above it; null rows are in neither."""
    return df.filter(F.col(column) < threshold), df.filter(F.col(column) >= threshold)


def split_blank(df: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """Rows with an empty text, and rows with some text; null rows are in neither."""
    return df.filter(F.col(column) == ""), df.filter(F.col(column) != "")


def non_blank(df: DataFrame, column: str) -> DataFrame:
    """Rows with some text in ``column``."""
    return split_blank(df, column)[1]


def with_status(df: DataFrame, status: str, column: str = "status") -> DataFrame:
    """Rows of one load status."""
    return df.filter(F.col(column) == status)


def where_all(df: DataFrame, *conditions: Column | str) -> DataFrame:
    """Rows meeting every condition."""
    for condition in conditions:
        df = df.filter(condition)
    return df
