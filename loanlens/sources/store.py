"""Results that several queries of one application read: made once, kept in the shared folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from loanlens.session import shared_folder
from loanlens.sources import snapshots

#: Tables written side by side; each still uses the whole cluster.
AT_ONCE = 4

_made: dict[tuple, object] = {}


def kept(spark: SparkSession, name: str, made_from: Sequence[DataFrame], make: Callable[[], object]):
    """What ``make`` returns for the files that ``made_from`` read; made again for other files and by other applications.

    ``make`` writes what it returns, so that it cannot go stale as long as files are not changed in place.
    """
    files = tuple(sorted(path for df in made_from for path in df.inputFiles()))
    key = (spark.sparkContext.applicationId, name, files)
    if key not in _made:
        _made[key] = make()
    return _made[key]


def written_together(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Write independent results side by side as one version, and read them back."""
    spark = next(iter(tables.values())).sparkSession
    root, version = f"{shared_folder(spark)}/kept-{uuid.uuid4().hex}", snapshots.new_version()

    def write(entry: tuple[str, DataFrame]) -> str:
        name, df = entry
        path = f"{root}/versions/{version}/{name}.parquet"
        df.write.parquet(path)
        return path

    with ThreadPoolExecutor(AT_ONCE) as threads:
        paths = dict(zip(tables, threads.map(write, tables.items()), strict=True))
    snapshots.publish(spark, root, version, {name: [path] for name, path in paths.items()})
    return {name: spark.read.schema(tables[name].schema).parquet(path) for name, path in paths.items()}
