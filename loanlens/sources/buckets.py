"""Tables laid out by a key, so that joins on it need no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame

#: A table of more rows takes more buckets; tables to be joined take the same number.
BUCKETS = 64


def write_bucketed(df: DataFrame, folder: str, name: str, key: str, buckets: int = BUCKETS, dealt: bool = False) -> DataFrame:
    """Write ``df`` with its rows hashed by ``key`` into ``buckets`` files, sorted in each, and read it back.

    The layout is part of the session's catalog entry ``name``; the files lie below ``folder``. Two
    tables with equal keys and numbers of buckets are joined bucket by bucket. ``dealt``: the rows
    come hashed by ``key`` into as many partitions, and are not shuffled again; any others would be
    written right too, in more files.
    """
    rows = df if dealt else df.repartition(buckets, key)
    rows.write.bucketBy(buckets, key).sortBy(key).option("path", f"{folder}/{name}").mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)
