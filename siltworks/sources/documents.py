"""JSON documents: reading, landing files, and splitting into chunks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siltworks.operators.keys import dense_key
from siltworks.session import open_files
from siltworks.sources.files import directly_in

# Chunks whose files a task writes side by side; a writer of JSON holds some kilobytes.
CHUNKS_AT_ONCE = 64


def read_json(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    mode: str = "PERMISSIVE",
    corrupt_column: str | None = None,
    multi_line: bool = True,
    name_glob: str | None = None,
    recursive: bool = False,
) -> DataFrame:
    """Scan JSON with the given schema, or an inferred one.

    A multi-line file is one document and one task, so large inputs should come as
    many files, or as JSON Lines with ``multi_line=False``, which Spark splits.
    To keep unparsable text, name a ``corrupt_column`` that the schema holds as a string.
    """
    reader = spark.read.option("multiLine", multi_line).option("mode", mode)
    if corrupt_column:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def read_landing(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    name_glob: str = "*",
    **options,
) -> DataFrame:
    """Scan the files directly in a landing folder whose names match, without copying them.

    Folders below it are passed over, also those named like partitions. A schema that is
    inferred takes matching files below into account.
    """
    found = read_json(spark, path, schema, name_glob=name_glob, recursive=True, **options)
    return found.filter(directly_in(path, F.col("_metadata.file_path")))


def chunk_of(position: Column, total: Column, chunks: int) -> Column:
    """The chunk of a 1-based position when ``total`` rows form ``chunks`` even slices.

    Slice *i* covers the positions from ``int(total*i/chunks)`` up to the next slice.
    """
    scaled = position.cast("long") * F.lit(chunks)
    return F.call_function("div", scaled + total - 1, total).cast("int") - 1


def chunked(
    df: DataFrame,
    chunks: int,
    order_by: Sequence[str],
    overlap: bool = False,
    replayable: bool = False,
    position: str | None = None,
) -> DataFrame:
    """Add a leading ``chunk`` number 0..chunks-1 to the rows in the given order.

    The chunks are disjoint. With ``overlap``, chunk 0 is the first slice and each
    later chunk *k* runs from slice *k* to the end, so that rows of slice *k* come
    *k* times: a way to make inputs full of copies. For ``replayable`` see
    :func:`~siltworks.operators.keys.dense_key`. ``position`` names a last column that
    keeps the row's place in the order, from 1.
    """
    numbered = dense_key(df, "_position", order_by, replayable)
    total = numbered.agg(F.count("*")).scalar()
    kept = [F.col("_position").alias(position)] if position else []
    placed = numbered.select(
        chunk_of(F.col("_position"), total, chunks).alias("chunk"), *df.columns, *kept
    )
    if not overlap:
        return placed
    first = F.least(F.lit(1), F.col("chunk"))
    return placed.withColumn("chunk", F.explode(F.sequence(first, F.col("chunk"))))


def split_documents(documents: DataFrame, array: str, chunks: int) -> DataFrame:
    """Elements of each document's array as ``chunk`` and ``element``, in even slices."""
    return documents.select(
        F.size(array).alias("_total"), F.posexplode(array).alias("_at", "element")
    ).select(chunk_of(F.col("_at") + 1, F.col("_total"), chunks).alias("chunk"), "element")


def write_chunks(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write rows with a ``chunk`` column as JSON Lines, one folder per chunk.

    Rows of up to ``CHUNKS_AT_ONCE`` chunks are written as they come, without a sort of a
    task's rows, which are several times its input where chunks overlap.
    """
    with open_files(df.sparkSession, CHUNKS_AT_ONCE):
        df.write.mode(mode).partitionBy("chunk").json(path)


def documents_of(
    df: DataFrame,
    array: str,
    rows_per_document: int,
    order_by: Sequence[str],
    replayable: bool = False,
) -> DataFrame:
    """Pack rows, in order, into documents that each hold an array of at most
    ``rows_per_document`` structs, numbered by ``document``."""
    position = F.col("_position") - 1
    return (
        dense_key(df, "_position", order_by, replayable)
        .select(
            F.call_function("div", position, F.lit(rows_per_document)).alias("document"),
            F.struct("_position", F.struct(*df.columns).alias("_row")).alias("_item"),
        )
        .groupBy("document")
        .agg(F.sort_array(F.collect_list("_item")).alias("_items"))
        .select("document", F.col("_items._row").alias(array))
    )


def split_landing(
    df: DataFrame,
    array: str,
    chunks: int,
    order_by: Sequence[str],
    path: str,
    rows_per_document: int = 10_000,
    overlap: bool = False,
    replayable: bool = False,
    mode: str = "errorifexists",
) -> None:
    """Split rows into chunks and write them as documents that a landing reader takes.

    Every line is a document ``{"chunk": k, array: [...]}`` of at most ``rows_per_document``
    rows, in files directly below ``path``; a chunk is as many documents as it needs.
    """
    placed = chunked(df, chunks, order_by, overlap, replayable, position="_position")
    number = F.call_function("div", F.col("_position") - 1, F.lit(rows_per_document))
    packed = (
        placed.withColumn("document", number)
        .groupBy("chunk", "document")
        .agg(
            F.sort_array(
                F.collect_list(F.struct("_position", F.struct(*df.columns).alias("_row")))
            ).alias("_items")
        )
        .select("chunk", F.col("_items._row").alias(array))
    )
    packed.write.mode(mode).json(path)


def write_documents(documents: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write each document as a JSON file of its own."""
    documents.drop("document").write.mode(mode).option("maxRecordsPerFile", 1).json(path)
