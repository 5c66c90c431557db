"""Sessions for tests, benchmark and stand-alone jobs, and tables shared between stages."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "12g") -> SparkSession:
    """A local session; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("loanlens")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )


@cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="loanlens-")


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, for tables that cut lineage.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session may
    fall back to a folder of its own machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return _own_folder()


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared folder and read it back.

    For results with several readers: they are computed once, and a lost
    executor does not bring back the work behind them.
    """
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}.parquet"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
