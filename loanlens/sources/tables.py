"""Raw CSV in, typed Parquet out: the six lending tables and their declared types."""

from __future__ import annotations

from collections.abc import Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from loanlens.lazy import Lazy

SCHEMAS = {
    "customers": "customer_id string, state string, city string, age int, employment_type string, "
    "monthly_income double, credit_segment string, created_at date",
    "bureau_features": "customer_id string, bureau_score int, active_loans int, credit_utilization double, "
    "enquiries_3m int, delinq_12m int",
    "loan_applications": "app_id string, customer_id string, application_date date, product string, "
    "requested_amount double, tenure_months int, channel string, approval_status string, "
    "rejection_reason string, approved_amount double, interest_rate double, risk_score double",
    "disbursements": "loan_id string, app_id string, customer_id string, disbursed_date date, principal double, "
    "tenure_months int, interest_rate double, risk_score double",
    "repayments": "loan_id string, due_date date, paid_date date, mob int, due_amount double, "
    "paid_amount double, dpd int",
    "collection_calls": "call_id string, loan_id string, call_date date, outcome string, agent_notes string",
}


def columns_of(table: str) -> list[tuple[str, str]]:
    return [tuple(field.split()) for field in SCHEMAS[table].split(", ")]


def typed(raw: DataFrame, table: str) -> DataFrame:
    """Select the declared columns by name and cast them; under ANSI mode a bad value stops the job."""
    return raw.selectExpr(*[f"CAST({name} AS {kind}) AS {name}" for name, kind in columns_of(table)])


def read_csv(spark: SparkSession, path: str, table: str, line_breaks: bool = True) -> DataFrame:
    """One table's CSV (file or folder of files), all columns as text.

    Quotes inside a quoted value are doubled. A row with more or fewer values
    than the header stops the job, and so does a header that names other
    columns. ``line_breaks``: values may hold line breaks; then a file is not
    split among tasks, so large tables come as many files, or without breaks.
    """
    names = ", ".join(f"{name} string" for name, _ in columns_of(table))
    options = {"header": True, "enforceSchema": False, "mode": "FAILFAST", "quote": '"', "escape": '"', "multiLine": line_breaks}
    return spark.read.schema(names).options(**options).csv(path)


def read_bronze(spark: SparkSession, folder: str, line_breaks: bool = True) -> dict[str, DataFrame]:
    """Types are declared, so no pass over the data infers them."""
    return {table: read_csv(spark, f"{folder}/{table}.csv", table, line_breaks) for table in SCHEMAS}


def silver(raw: Mapping[str, DataFrame]) -> Lazy:
    return Lazy({table: partial(lambda name: typed(raw[name], name), table) for table in SCHEMAS})


def read_tables(spark: SparkSession, folder: str, names: list[str]) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{folder}/{name}.parquet") for name in names}


def write_table(df: DataFrame, folder: str, name: str, month: str | None = None) -> None:
    """Overwrite one Parquet table.

    With ``month`` the table is laid out by that column, so a query on recent
    months reads only their folders. The rebalance hint sizes the files and
    lets adaptive execution split a month that is much larger than the others.
    """
    target = f"{folder}/{name}.parquet"
    if month is None:
        df.write.mode("overwrite").parquet(target)
    else:
        df.hint("rebalance", month).write.mode("overwrite").partitionBy(month).parquet(target)


def write_report(report: DataFrame, folder: str, name: str) -> None:
    """A report of a few dozen rows, as Parquet and, from that, as one CSV with a header."""
    report.coalesce(1).write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    written = report.sparkSession.read.schema(report.schema).parquet(f"{folder}/{name}.parquet")
    written.coalesce(1).write.mode("overwrite").option("header", True).option("escape", '"').csv(f"{folder}/{name}.csv")
