"""Batch jobs that write tables. Each stage reads what the stage before it wrote,
so a lost executor costs at most the stage that is running.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from loanlens.operators import retrieval
from loanlens.plans import analysis, marts, quality
from loanlens.sources import snapshots, tables

MONTH_OF_MART = {
    "gold_loan_features": "disbursed_month",
    "gold_repayment_enriched": "disbursed_month",
}
REPORT = "gold_data_quality_report"
GOLD = [
    "gold_loan_features",
    "gold_repayment_enriched",
    "gold_approval_funnel",
    "gold_portfolio_summary",
    "gold_dpd_bucket_analysis",
    "gold_vintage_analysis",
]


def build_silver(spark: SparkSession, raw: Mapping[str, DataFrame], folder: str) -> dict[str, DataFrame]:
    for name, df in tables.silver(raw).items():
        tables.write_table(df, folder, name)
    return tables.read_tables(spark, folder, list(tables.SCHEMAS))


def build_gold(spark: SparkSession, t: Mapping[str, DataFrame], folder: str) -> dict[str, DataFrame]:
    """Loan features and enriched repayments are read back before the marts that aggregate them."""

    def stored(name: str, df: DataFrame) -> DataFrame:
        tables.write_table(df, folder, name, MONTH_OF_MART.get(name))
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}.parquet")

    features = stored("gold_loan_features", marts.loan_features(t))
    enriched = stored("gold_repayment_enriched", marts.repayment_enriched(t["repayments"], features))
    return {
        "gold_loan_features": features,
        "gold_repayment_enriched": enriched,
        "gold_approval_funnel": stored("gold_approval_funnel", marts.approval_funnel(t)),
        "gold_portfolio_summary": stored("gold_portfolio_summary", marts.portfolio_summary(features)),
        "gold_dpd_bucket_analysis": stored("gold_dpd_bucket_analysis", marts.dpd_bucket_analysis(enriched)),
        "gold_vintage_analysis": stored("gold_vintage_analysis", marts.vintage_analysis(enriched)),
    }


def build_all(spark: SparkSession, in_dir: str, out_dir: str) -> DataFrame:
    """CSV to typed tables, marts and quality report; returns the rows per mart."""
    t = build_silver(spark, tables.read_bronze(spark, in_dir), f"{out_dir}/silver")
    gold = build_gold(spark, t, f"{out_dir}/gold")
    tables.write_report(quality.report(t), f"{out_dir}/gold", REPORT)
    return analysis.row_counts(gold, spark.read.parquet(f"{out_dir}/gold/{REPORT}.parquet"))


def read_gold(spark: SparkSession, out_dir: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{out_dir}/gold/{name}.parquet") for name in [*GOLD, REPORT]}


def ensure_built(spark: SparkSession, in_dir: str, corpus: DataFrame, out_dir: str) -> bool:
    """Build tables, marts, report and text index unless they are all there; returns whether anything was built.

    A manifest that is written last says that they are. A build that stopped anywhere has none and
    is made again as a whole; a table that was taken away since makes it incomplete, too.
    """
    found = snapshots.current(spark, out_dir)
    if found is not None and all(exists(spark, path) for paths in found.values() for path in paths):
        return False
    build_all(spark, in_dir, out_dir)
    retrieval.write_index(corpus, f"{out_dir}/index")
    tables_there = {f"silver/{name}": [f"{out_dir}/silver/{name}.parquet"] for name in tables.SCHEMAS}
    tables_there |= {f"gold/{name}": [f"{out_dir}/gold/{name}.parquet"] for name in [*GOLD, REPORT]}
    tables_there |= {f"index/{name}": paths for name, paths in snapshots.current(spark, f"{out_dir}/index").items()}
    snapshots.publish(spark, out_dir, snapshots.new_version(), tables_there)
    return True


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a table that was written to its end is there; the file system is the one Spark uses."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS"))
