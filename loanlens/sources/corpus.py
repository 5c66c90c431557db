"""Text sources with provenance: rows of ``source, text``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_text_files(spark: SparkSession, folder: str, pattern: str = "*.md") -> DataFrame:
    """Every matching file whole, with its file name as the source."""
    files = spark.read.option("pathGlobFilter", pattern).text(folder, wholetext=True)
    return files.select(F.col("_metadata.file_name").alias("source"), F.col("value").alias("text"))


#: Bytes of files per core up to which texts are dealt to all cores before they are read closely.
SMALL = 1 << 24


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    return documents.select(F.col("doc_id").cast("string").alias("source"), "text")


def spread(documents: DataFrame) -> DataFrame:
    """A small corpus dealt to all cores, a large one as it is.

    A Parquet file is read by row groups, and a small one may have a single one, which a single core
    would then go through. Large corpora have more row groups than cores and are not shuffled.
    """
    cores = documents.sparkSession.sparkContext.defaultParallelism
    size = int(documents._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return documents.repartition(cores, "source") if size <= SMALL * cores else documents
