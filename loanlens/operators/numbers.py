"""Keys as dense numbers, and sets of them as bitmaps that can be joined without counting anew."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Hash ranges in which keys are numbered side by side.
RANGES = 256


def dense_numbers(keys: DataFrame, key: str, first: int = 1, near: str | None = None) -> DataFrame:
    """``key, number`` of the distinct values of ``key``, from ``first`` on without gaps.

    Values are numbered within hash ranges, and only the sizes of the ranges are put in order, so no
    task sorts all of them. With ``near``, the values that share it are numbered next to each other,
    which keeps the bitmaps of such groups short; of several values of ``near`` the lowest counts.
    """
    lead = F.lit(0) if near is None else F.min(near)
    each = keys.groupBy(key).agg(lead.alias("lead")).withColumn("range", F.pmod(F.xxhash64(key), F.lit(RANGES)).cast("int"))
    sizes = each.groupBy("lead", "range").agg(F.count(F.lit(1)).alias("size"))
    before = Window.orderBy(F.asc_nulls_first("lead"), "range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("lead", "range", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("lead", "range").orderBy(key))
    placed = each.withColumn("within", within).alias("e").join(
        F.broadcast(offsets.alias("o")), F.col("e.lead").eqNullSafe(F.col("o.lead")) & (F.col("e.range") == F.col("o.range"))
    )
    return placed.select(f"e.{key}", (F.lit(first) - 1 + F.col("before") + F.col("within")).alias("number"))


def bitmaps(rows: DataFrame, keys: Sequence[str], number: str = "number") -> DataFrame:
    """``keys, bucket, bits``: the numbers that occur in each group; rows without a number are left out."""
    n = F.col(number)
    numbered = rows.where(n.isNotNull())
    return numbered.groupBy(*keys, F.bitmap_bucket_number(n).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(n)).alias("bits")
    )


def joined(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The bitmaps of coarser groups, or of the same groups from several parts."""
    return parts.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_counts(parts: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """``keys, name``: how many different numbers each group of ``keys`` has, exactly."""
    return joined(parts, keys).groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias(name))


def same(keys: Sequence[str], left: str, right: str) -> Column:
    """Rows of equal groups, where a missing value is a group like any other."""
    found = F.lit(True)
    for key in keys:
        found = found & F.col(f"{left}.{key}").eqNullSafe(F.col(f"{right}.{key}"))
    return found
