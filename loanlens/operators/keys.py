"""Key checks that collapse to one row per key before anything is compared."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def orphan_count(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """One row ``orphans, rows``: child rows whose key has no parent; a missing key is an orphan.

    Child rows collapse to one row per key before the shuffle, and the anti
    join reuses that shuffle, so a hot key costs nothing extra.
    """
    per_key = child.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.join(parent.select(key), key, "left_anti").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("orphans"))


def duplicate_key_groups(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row ``repeated``: how many key combinations occur more than once."""
    return (
        rows.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .agg(F.count(F.lit(1)).alias("repeated"))
    )
