"""A training corpus from ``documents``: quality, near-duplicates, privacy, mixture, packing."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loanlens.llm import mixing, packing, pii, quality, simhash
from loanlens.llm.queries import pseudonym_key, tokenizer_path
from loanlens.session import shared_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Drop what the quality classifier rejects. Word vectors come from all of ``docs``."""
    return quality.accepted(docs, spark.read.parquet(f"{folder}/labels.parquet"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Keep the document with the smallest id of each group of near-duplicates (four-word shingles, four bits)."""
    return simhash.one_of_each(docs)


def hide_personal_data(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Replace personal numbers, dates and addresses in every text."""
    return pii.pseudonymized(docs, pseudonym_key(spark))


def mix(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Repeat and sample the documents of each source to its target."""
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Cut the documents into tokens and pack them into sequences."""
    return packing.packed(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", keep_good),
    ("SimHash near-dedup", keep_one_of_each),
    ("PII", hide_personal_data),
    ("mixing sources to target weights", mix),
    ("best-fit packing", pack),
]

#: The classifier, the tokenizer and the digests have no counterpart in SQL; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared folder and read again by the next."""
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
    return docs
