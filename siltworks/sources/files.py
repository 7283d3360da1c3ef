"""Storage inventory."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.functions.text import fixed_width


_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"


def directly_in(folder: str, file_path: Column) -> Column:
    """Whether a file lies in the folder itself, not in one below it.

    Spark's file listing either takes in the folders below, or takes ``key=value`` folders for
    partitions and then passes over the files beside them. So everything is listed and
    the files below are filtered out.
    """
    own = re.sub(_SCHEME, "", folder).rstrip("/")
    parent = F.regexp_replace(F.regexp_replace(file_path, _SCHEME, ""), "/[^/]*$", "")
    decoded = F.coalesce(F.try_url_decode(F.replace(parent, F.lit("+"), F.lit("%2B"))), parent)
    if not own.startswith("/"):
        return F.endswith(parent, F.lit(f"/{own}")) | F.endswith(decoded, F.lit(f"/{own}"))
    return (parent == own) | (decoded == own)


def inventory(
    spark: SparkSession, path: str, name_glob: str = "*", recursive: bool = True
) -> DataFrame:
    """Name, type, size and modification time of the files below ``path``, without reading them.

    The type is the file extension. Empty files, and those whose names start with
    ``_`` or ``.``, are not data to Spark and are left out.
    """
    name = F.element_at(F.split("path", "/"), -1)
    found = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", name_glob)
        .load(path)
    )
    if not recursive:
        found = found.filter(directly_in(path, F.col("path")))
    return (
        found.select(
            name.alias("name"),
            F.regexp_extract(name, r"\.([^.]+)$", 1).alias("type"),
            F.col("length").alias("size"),
            F.col("modificationTime").alias("modified"),
            "path",
        )
    )


def inventory_lines(files: DataFrame) -> DataFrame:
    """The inventory as lines of padded text."""
    # The column widths of a listing.
    line = fixed_width(("name", 100), ("type", 10), ("size", 10), gap={1: "  "})
    return files.select(line.alias("line"))
