"""Landing files as a stream: each file is loaded once, then cleared away."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from siltworks.sources.files import directly_in


def stream_landing(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    name_glob: str = "*",
    multi_line: bool = True,
    files_per_batch: int | None = None,
    clean: str = "off",
    archive: str | None = None,
) -> DataFrame:
    """JSON documents from the files directly in a landing folder, as they appear.

    ``clean`` is what becomes of a file after the batch that loaded it: ``off``,
    ``delete``, or ``archive`` to the folder named.
    """
    reader = (
        spark.readStream.schema(schema)
        .option("multiLine", multi_line)
        .option("pathGlobFilter", name_glob)
        .option("recursiveFileLookup", True)
        .option("cleanSource", clean)
    )
    if archive:
        reader = reader.option("sourceArchiveDir", archive)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path).filter(directly_in(path, F.col("_metadata.file_path")))


def load_available(
    rows: DataFrame, path: str, checkpoint: str, partition_by: tuple[str, ...] = ("ingestdate",)
) -> StreamingQuery:
    """Append all rows waiting in a stream to a Parquet folder, then stop.

    Started again with the same ``checkpoint`` folder, it loads only what is new.
    """
    return (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .partitionBy(*partition_by)
        .trigger(availableNow=True)
        .start(path)
    )
