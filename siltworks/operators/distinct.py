"""Distinct rows, unions and occurrence counts.

Every grouping here combines on the map side first, so copies of one record
collapse before the shuffle however many there are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from siltworks.functions.identity import row_key
from siltworks.operators.joins import is_in
from siltworks.session import open_files
from siltworks.staging import settle, staged_path

# A repeated hash gets so many bits of a bitmap, between these limits; 2 ** 30 bits are 128 MB.
BITS_PER_REPEATED = 64
LEAST_BITS = 1 << 15
MOST_BITS = 1 << 30


def distinct_union(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Set union by column name."""
    return append_all(first, *others).distinct()


def append_all(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows of several frames, by column name."""
    for other in others:
        first = first.unionByName(other)
    return first


def _by_hash(df: DataFrame, *columns: str) -> tuple[DataFrame, DataFrame]:
    """Rows with the hash of some columns, and the written hashes that more than one row has."""
    keyed = df.withColumn("_row_key", row_key(*columns))
    counted = keyed.groupBy("_row_key").count().filter("count > 1").select("_row_key")
    return keyed, settle(counted, "repeated", plain=True)


def duplicates(df: DataFrame, column: str) -> DataFrame:
    """Values held by more than one row, with the number of ``copies``; null counts as a value.

    A first pass shuffles only hashes; then just the values whose hash repeats are
    compared, so that a wide value that is unique is never shuffled for itself.
    """
    keyed, repeated = _by_hash(df.select(column), column)
    some = is_in(keyed, "_row_key", repeated, distinct_keys=True)
    return some.groupBy(column).agg(F.count("*").alias("copies")).filter("copies > 1")


def _mark_bits(repeated: int) -> int:
    """Bits of a bitmap in which few unique hashes meet a repeated one; a power of two."""
    wanted = max(repeated, 1) * BITS_PER_REPEATED
    return min(max(1 << (wanted - 1).bit_length(), LEAST_BITS), MOST_BITS)


def hash_marks(hashes: DataFrame, bits: int) -> DataFrame:
    """A bitmap of hashes modulo ``bits``: ``_bucket`` and the 4 KB ``_marks`` of its positions."""
    place = F.pmod("_row_key", F.lit(bits))
    return hashes.groupBy(F.bitmap_bucket_number(place).alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("_marks")
    )


def marked(keyed: DataFrame, marks: DataFrame, bits: int, name: str) -> DataFrame:
    """Rows with whether the bit of their ``_row_key`` is set; ``marks`` is at most ``bits`` / 8 bytes."""
    place = F.pmod("_row_key", F.lit(bits))
    bit = F.bitmap_bit_position(place)
    byte = F.substring("_marks", F.floor(bit / 8).cast("int") + 1, F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("int")
    is_set = F.expr("shiftright(_value, _shift) & 1 = 1")
    joined = keyed.withColumn("_at", F.bitmap_bucket_number(place)).join(
        F.broadcast(marks), F.col("_at") == F.col("_bucket"), "left"
    )
    return (
        joined.withColumns({"_value": value, "_shift": (bit % 8).cast("int")})
        .withColumn(name, F.coalesce(is_set, F.lit(False)))
        .drop("_at", "_bucket", "_marks", "_value", "_shift")
    )


def distinct_records(df: DataFrame) -> DataFrame:
    """Distinct rows, for wide rows of which few repeat.

    A first reading of ``df`` shuffles hashes. Those that repeat become a bitmap of at most
    ``MOST_BITS`` bits, which is broadcast whatever the join threshold; a second reading writes
    the rows with a set bit apart from the others. Only the former are compared, so a row
    whose hash is unique crosses no exchange, but for the few that share a bit. ``df`` is read
    twice, so its rows should be the same each time.
    """
    keyed, repeated = _by_hash(df, *df.columns)
    copies = repeated.count()
    if not copies:
        return df
    bits = _mark_bits(copies)
    rows = marked(keyed, hash_marks(repeated, bits), bits, "_again").drop("_row_key")
    path = staged_path(df.sparkSession, "records")
    with open_files(df.sparkSession, 2):
        rows.write.partitionBy("_again").parquet(path)
    schema = StructType([*df.schema.fields, StructField("_again", BooleanType())])
    staged = df.sparkSession.read.schema(schema).parquet(path)
    single = staged.filter(~F.col("_again")).drop("_again")
    return single.unionByName(staged.filter("_again").drop("_again").distinct())


def singletons(df: DataFrame, column: str) -> DataFrame:
    """Values with fewer than two non-null occurrences, with their ``occurrences``.

    A null group counts none of its rows, so it passes.
    """
    return df.groupBy(column).agg(F.count(column).alias("occurrences")).filter("occurrences < 2")
