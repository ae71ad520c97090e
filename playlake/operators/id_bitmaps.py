"""Id sets as bucketed bitmaps (S2, A9, J5): a row of 4 KB for each 32,768 possible ids.

An id is a bit of its bucket's bitmap. Sets are built and merged by aggregates that combine map-side, so
an id landed a billion times is a bit, and what is shuffled is bounded by the ids there can be. A set of all
ids up to a hundred million is 3,000 rows; looking ids up joins them with their bucket's row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITMAP_DDL = "bucket bigint, bitmap binary"
BITS = 32_768  # fixed value: bits of a bitmap of Spark's aggregates


def id_bitmaps(ids: DataFrame, column: str = "appid") -> DataFrame:
    """The set of the ids of a column, nulls left out, as ``(bucket, bitmap)``."""
    rows = ids.select(F.col(column).cast("bigint").alias("i")).where("i is not null")
    return rows.groupBy(F.bitmap_bucket_number("i").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("i")).alias("bitmap"))


def merged_bitmaps(*sets: DataFrame) -> DataFrame:
    """The union of several sets."""
    rows = sets[0]
    for other in sets[1:]:
        rows = rows.unionByName(other)
    return rows.groupBy("bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def _holds(bitmap: Column, position: Column) -> Column:
    """Whether the bit at ``position`` is set: bit ``position % 8`` of byte ``position / 8``."""
    octet = F.substring(bitmap, (F.shiftright(position, 3) + 1).cast("int"), F.lit(1))
    value = F.conv(F.hex(octet), 16, 10).cast("int")
    return F.call_function("shiftright", value, F.pmod(position, F.lit(8)).cast("int")).bitwiseAND(1) == 1


def not_in_bitmaps(rows: DataFrame, known: DataFrame, column: str = "appid") -> DataFrame:
    """The rows whose id is not in the set, all columns; a null id is in no set.

    Only rows whose bucket has a bitmap can be dropped; the bitmaps are one row a bucket, so the join
    adds no row, and adaptive execution broadcasts them where their size allows.
    """
    i = F.col(column).cast("bigint")
    sets = known.select(F.col("bucket").alias("_bucket"), F.col("bitmap").alias("_bitmap"))
    joined = rows.join(sets, F.bitmap_bucket_number(i) == F.col("_bucket"), "left")
    held = F.coalesce(_holds(F.col("_bitmap"), F.bitmap_bit_position(i)), F.lit(False))
    return joined.where(~held).select(rows.columns)


def bitmap_ids(sets: DataFrame, column: str = "appid") -> DataFrame:
    """The ids of a set, each once. Buckets from 1 on hold positive ids, the others zero and below."""
    bits = sets.select("bucket", "bitmap", F.explode(F.sequence(F.lit(0), F.lit(BITS - 1))).alias("p")).where(
        _holds(F.col("bitmap"), F.col("p")))
    positive = (F.col("bucket") - 1) * BITS + F.col("p") + 1
    return bits.select(F.when(F.col("bucket") > 0, positive).otherwise(F.col("bucket") * BITS - F.col("p")).alias(column))
