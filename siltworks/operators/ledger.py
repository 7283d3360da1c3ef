"""Records of earlier loads, remembered as hashes in a bucketed table.

The table is bucketed by what it is joined on, so a new load brings its own hashes to the buckets
and the remembered ones are read in place, however many there are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.functions.identity import row_key, second_key
from siltworks.staging import settle

BUCKETS = 64
_PRINT = ["_row_key", "_second"]


def _printed(df: DataFrame, column: str) -> DataFrame:
    """Two 64-bit hashes of a record; together they stand for it where it cannot be read again."""
    return df.withColumns(
        {"_row_key": row_key(column), "_second": second_key(column)}
    )


def _counts(df: DataFrame, column: str) -> DataFrame:
    return _printed(df.select(column), column).groupBy(*_PRINT).agg(F.count("*").alias("_copies"))


def remember(
    df: DataFrame, column: str, table: str, path: str, load: str = "", buckets: int = BUCKETS
) -> None:
    """Add the records of a ``load`` to the ledger ``table``, which is created below ``path``.

    Look a load up before it is added. A named load that is added again counts once. The number
    of buckets is that of the first load; it should suit the ledger in its last size.
    """
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        buckets = bucket_number(spark, table)
    name = F.lit(load) if load else F.uuid()
    counted = _counts(df, column).repartition(buckets, *_PRINT).withColumn("_load", name)
    writer = counted.write.bucketBy(buckets, *_PRINT).sortBy(*_PRINT)
    writer.format("parquet").mode("append").option("path", path).saveAsTable(table)


def bucket_number(spark: SparkSession, table: str) -> int:
    rows = spark.sql("DESCRIBE TABLE EXTENDED IDENTIFIER(:table)", args={"table": table})
    return int(rows.filter("col_name = 'Num Buckets'").first()["data_type"])


def remembered(df: DataFrame, column: str, table: str, load: str = "") -> DataFrame:
    """Hashes of the records of ``df`` with their copies in it, in ``_earlier`` loads, and those ``_loads``.

    ``load`` is the name of this load, of which the ledger may hold rows of an earlier try.
    """
    spark = df.sparkSession
    own = _counts(df, column)
    if not spark.catalog.tableExists(table):
        return own.withColumns({"_earlier": F.lit(0).cast("long"), "_loads": F.array().cast("array<string>")})
    once = (
        spark.read.table(table)
        .filter(F.col("_load") != load)
        .groupBy(*_PRINT, "_load")
        .agg(F.max("_copies").alias("_copies"))
    )
    earlier = once.groupBy(*_PRINT).agg(
        F.sum("_copies").alias("_earlier"), F.collect_set("_load").alias("_loads")
    )
    # As many partitions as buckets, so that nothing of the ledger moves.
    dealt = own.repartition(bucket_number(spark, table), *_PRINT)
    joined = dealt.join(earlier.hint("merge"), _PRINT, "left")
    return joined.withColumns(
        {
            "_earlier": F.coalesce("_earlier", F.lit(0).cast("long")),
            "_loads": F.coalesce("_loads", F.array().cast("array<string>")),
        }
    )


def duplicates_across(df: DataFrame, column: str, table: str) -> DataFrame:
    """Values of this load that more than one row holds, here and in earlier loads together.

    Returns the value, its ``copies`` in all loads, and those in ``earlier`` ones; null counts as a
    value. Only values whose hash repeats are shuffled for themselves.
    """
    found = remembered(df, column, table).filter("_copies + _earlier > 1")
    repeated = settle(found.select(*_PRINT, "_earlier"), "repeated", plain=True)
    rows = _printed(df.select(column), column)
    some = rows.join(repeated, _PRINT, "inner")
    return some.groupBy(column).agg(
        (F.count("*") + F.first("_earlier")).alias("copies"), F.first("_earlier").alias("earlier")
    )
