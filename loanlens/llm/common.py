"""What several of the operators share: ranks without one large sort task, and rows carried whole."""

from __future__ import annotations

import sys
import types

import pyarrow.fs
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Size of the count table behind one rank, per group. A group of any size is sorted in so many tasks.
BUCKETS = 4096

ROW = "carried_row"


def carried(df: DataFrame) -> DataFrame:
    """The rows of ``df`` as one column, so that no name of theirs can clash with an operator's own."""
    return df.select(F.struct(*[df[f"`{c}`"] for c in df.columns]).alias(ROW))


def unpacked(df: DataFrame, columns: list[str], *added: str) -> DataFrame:
    """Undo ``carried``: the rows' ``columns``, then the ``added`` ones, which replace namesakes."""
    kept = [F.col(f"{ROW}.`{c}`").alias(c) for c in columns if c not in added]
    return df.select(*kept, *added)


def unit(*parts: Column | str) -> Column:
    """A repeatable number in (0, 1), even over the parts' values: 52 bits of their digest."""
    text = F.concat_ws("|", *[F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit("-")) for p in parts])
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(2**52))


def ranked(df: DataFrame, keys: list[str], order: list[Column | str], bucket: Column, rank: str, count: str) -> DataFrame:
    """Add the 0-based ``rank`` of each row among the rows with its ``keys``, and their ``count``.

    ``bucket`` is an integer in 0..BUCKETS-1 that never falls along ``order`` and spreads rows
    evenly; a hot key is sorted bucket by bucket, in as many tasks. The keys must not be null.
    """
    cut = df.withColumn("rank_bucket", bucket)
    sizes = cut.groupBy(*keys, "rank_bucket").agg(F.count(F.lit(1)).alias("bucket_rows"))
    before = Window.partitionBy(*keys).orderBy("rank_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *keys,
        "rank_bucket",
        F.coalesce(F.sum("bucket_rows").over(before), F.lit(0)).alias("rows_before"),
        F.sum("bucket_rows").over(Window.partitionBy(*keys)).alias(count),
    )
    within = Window.partitionBy(*keys, "rank_bucket").orderBy(*order)
    return (
        cut.withColumn("rank_within", F.row_number().over(within) - 1)
        .join(offsets, [*keys, "rank_bucket"])
        .withColumn(rank, F.col("rows_before") + F.col("rank_within"))
        .drop("rank_bucket", "rank_within", "rows_before")
    )


def bucket_of(fraction: Column) -> Column:
    """The bucket of a number in [0, 1)."""
    return F.least(F.floor(fraction * BUCKETS), F.lit(BUCKETS - 1)).cast("int")


def kept_by_worker(name: str) -> dict:
    """What a Python worker process keeps from one task to the next, for caches that decide no result."""
    module = sys.modules.setdefault("_loanlens_kept", types.ModuleType("_loanlens_kept"))
    return vars(module).setdefault(name, {})


def file_system(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a folder that all executors reach, and the folder's path in it."""
    return pyarrow.fs.FileSystem.from_uri(uri)
