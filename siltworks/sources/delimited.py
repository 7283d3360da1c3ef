"""Tab-separated input and comma-separated output."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_tsv(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    mode: str = "FAILFAST",
    corrupt_column: str | None = None,
    blank_lines: bool = True,
) -> DataFrame:
    """Scan tab-separated files that have one header line and no quoting.

    A line with another number of fields than the schema fails the job, whichever
    columns are selected: column pruning is off because it would skip that check.
    With ``mode="PERMISSIVE"`` and a ``corrupt_column``, such lines are kept there.
    Empty text fields are empty strings. The CSV reader passes over lines of nothing but
    blanks and tabs; they are read once more as text, and count like any other line. Without
    ``blank_lines`` they are passed over and each file is read once.
    """
    reader = (
        spark.read.option("sep", "\t")
        .option("header", True)
        .option("quote", "")
        .option("mode", mode)
        .option("columnPruning", False)
        .schema(schema)
    )
    if corrupt_column:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    rows = reader.csv(path)
    if blank_lines:
        rows = rows.unionByName(_blank_lines(spark, path, rows.schema, mode, corrupt_column))
    texts = [
        field.name
        for field in rows.schema
        if field.dataType.typeName() == "string" and field.name != corrupt_column
    ]
    return rows.na.fill("", texts) if texts else rows


def _blank_lines(
    spark: SparkSession, path: str, schema: StructType, mode: str, corrupt_column: str | None
) -> DataFrame:
    """Lines of blanks and tabs only, as rows of ``schema``."""
    lines = spark.read.text(path).filter(F.rlike("value", F.lit(r"^[\x00-\x20]*$")))
    fields = F.split("value", "\t", -1)
    wanted = [field for field in schema if field.name != corrupt_column]
    right = F.size(fields) == len(wanted)
    columns = []
    for i, field in enumerate(wanted):
        value = F.get(fields, F.lit(i)).try_cast(field.dataType)
        if mode.upper() == "FAILFAST":
            message = F.lit("a line has another number of fields than the schema")
            value = F.when(right, value).otherwise(F.raise_error(message).cast(field.dataType))
        columns.append(value.alias(field.name))
    if corrupt_column in schema.fieldNames():
        columns.append(F.when(~right, F.col("value")).alias(corrupt_column))
    elif mode.upper() == "DROPMALFORMED":
        lines = lines.filter(right)
    return lines.select(*columns)


def csv_writer(df: DataFrame, mode: str = "errorifexists", line_end: str = "\n") -> DataFrameWriter:
    """An unstarted writer of comma-separated files with a header.

    A field is quoted only where needed, with quotes doubled inside, and an empty
    text is written as nothing. Blanks around a value are part of it, and
    times keep their microseconds. With another ``line_end``, line feeds inside texts
    are written as that too.
    """
    return (
        df.write.format("csv")
        .mode(mode)
        .option("header", True)
        .option("escape", '"')
        .option("emptyValue", "")
        .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
        .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("lineSep", line_end)
    )
