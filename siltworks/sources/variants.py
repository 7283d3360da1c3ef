"""Documents whose layout drifts: read as they are, taken apart by type, and reported on."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType


def read_variant(
    spark: SparkSession, path: str, column: str = "document", multi_line: bool = False, **options
) -> DataFrame:
    """JSON documents as one VARIANT column, whatever fields they have; nothing is inferred."""
    return (
        spark.read.format("json")
        .option("singleVariantColumn", column)
        .option("multiLine", multi_line)
        .options(**options)
        .load(path)
    )


def _step(name: str) -> str:
    return f".{name}" if re.fullmatch(r"[A-Za-z_]\w*", name) else f"['{name}']"


def typed(df: DataFrame, fields: Mapping[str, str | tuple[str, str]], column: str = "document") -> DataFrame:
    """Columns of a variant: the type of each field, or its path (``$.a.b``) and type.

    A field that a document lacks, or whose value does not fit the type, is null.
    """
    found: list[Column] = []
    for name, wanted in fields.items():
        path, kind = ("$" + _step(name), wanted) if isinstance(wanted, str) else wanted
        found.append(F.try_variant_get(column, path, kind).alias(name))
    others = [name for name in df.columns if name != column]
    return df.select(*found, *others)


def found_schema(df: DataFrame, column: str = "document") -> DataType:
    """The fields and types that the documents have, all taken together, by one aggregate."""
    text = df.agg(F.schema_of_variant_agg(column)).first()[0] or "VOID"
    spark = df.sparkSession
    return spark.createDataFrame([], f"found {text.replace('OBJECT<', 'STRUCT<')}").schema["found"].dataType


def paths_of(kind: DataType, path: str = "$") -> dict[str, str]:
    """The paths below a type with the types there; elements of arrays are ``[]``."""
    found: dict[str, str] = {}
    if isinstance(kind, StructType):
        for field in kind.fields:
            below = path + _step(field.name)
            found[below] = field.dataType.simpleString()
            found |= paths_of(field.dataType, below)
    elif isinstance(kind, ArrayType):
        if not isinstance(kind.elementType, (StructType, ArrayType)):
            found[f"{path}[]"] = kind.elementType.simpleString()
        found |= paths_of(kind.elementType, f"{path}[]")
    return found


def unknown_paths(df: DataFrame, known: StructType, column: str = "document") -> DataFrame:
    """Paths that documents have and ``known`` lacks: ``path``, ``type`` and number of ``documents``.

    Below an unknown path nothing more is told, and below one that is known as a variant everything
    is known. Inside arrays the documents are those that have
    the array. ``df`` is read twice; only the schema of the documents comes to the driver.
    """
    expected = {path.lower(): kind for path, kind in paths_of(known).items()}
    anything = tuple(path for path, kind in expected.items() if kind == "variant")

    def below(path: str, others) -> bool:
        return any(path.startswith((f"{other}.", f"{other}[")) for other in others)

    unknown = {
        path: kind for path, kind in paths_of(found_schema(df, column)).items()
        if path.lower() not in expected and not below(path.lower(), anything)
    }
    top = {path: kind for path, kind in unknown.items() if not below(path, unknown.keys() - {path})}
    spark = df.sparkSession
    if not top:
        return spark.createDataFrame([], "path string, type string, documents long")
    names = list(top)
    counts = df.agg(
        *(
            F.count(F.try_variant_get(column, name.split("[]")[0], "variant")).alias(f"c{i}")
            for i, name in enumerate(names)
        )
    )
    rows = spark.createDataFrame([(f"c{i}", name, top[name]) for i, name in enumerate(names)], "at string, path string, type string")
    counted = counts.unpivot([], [f"c{i}" for i in range(len(names))], "at", "documents")
    return rows.join(F.broadcast(counted), "at").select("path", "type", "documents")
