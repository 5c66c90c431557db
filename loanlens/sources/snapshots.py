"""Versions of a set of tables, of which readers see only complete ones.

Each build writes its tables below a folder of its own version and then, last, a manifest with their
paths. A manifest is one small file that its job moves into place at the end, so it is there as a
whole or not at all. A build that stops at any point leaves files that no manifest names.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "version string, table string, place int, path string"


def new_version() -> str:
    """A name that sorts behind those made before it."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def publish(spark: SparkSession, root: str, version: str, tables: Mapping[str, Sequence[str]]) -> None:
    """Make a version the current one: table names with the paths that together hold each."""
    rows = [(version, name, place, path) for name, paths in tables.items() for place, path in enumerate(paths)]
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.json(f"{root}/manifests/{version}")


def current(spark: SparkSession, root: str) -> dict[str, list[str]] | None:
    """The tables of the latest complete version, or None. One job: manifests are small, and one task finds the latest."""
    try:
        rows = spark.read.schema(MANIFEST).json(f"{root}/manifests/*").coalesce(1)
        versions = rows.groupBy("version").agg(F.collect_list(F.struct("table", "place", "path")).alias("named"))
        latest = versions.agg(F.max_by("named", "version").alias("named")).first()["named"]
    except AnalysisException:
        return None
    found: dict[str, list[str]] = {}
    for table, _, path in sorted(latest or []):
        found.setdefault(table, []).append(path)
    return found or None


def read(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table of the current version."""
    found = current(spark, root)
    if found is None or name not in found:
        raise ValueError(f"no complete version with {name} at {root}")
    return spark.read.parquet(*found[name])
