"""Lending tables derived from an order-entry star schema.

The available tables hold customers, orders and order lines rather than loans.
Read as lending data, an order is a loan application, an order with status F
was approved and disbursed, and its lines are the instalments of that loan.
Every row of the tables takes part: lines of orders that were not approved are
repayments without a loan, and customers in debt have a bureau record without a
score.
"""

from __future__ import annotations

from functools import cache, partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.functions.lending import income_segment
from loanlens.functions.phrases import DEMO_QUESTIONS
from loanlens.lazy import Lazy

# How codes of the order-entry tables read as lending terms.
EMPLOYMENT = {
    "BUILDING": "Salaried",
    "AUTOMOBILE": "Self-employed",
    "MACHINERY": "Gig worker",
    "HOUSEHOLD": "Small business",
    "FURNITURE": "Salaried",
}
PRODUCT = {
    "1-URGENT": "Personal Loan",
    "2-HIGH": "Two Wheeler Loan",
    "3-MEDIUM": "Consumer Durable Loan",
    "4-NOT SPECIFIED": "Merchant Loan",
    "5-LOW": "Personal Loan",
}
QUESTION_OF_EVENT = dict(zip(["click", "view", "purchase", "signup", "error"], DEMO_QUESTIONS, strict=True))


def _mapped(column: str, terms: dict[str, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{code}' THEN '{term}'" for code, term in terms.items()) + " END"


class StarSchema:
    """The tables of one folder, as lending tables under ``lending`` and a few more."""

    def __init__(self, spark: SparkSession, folder: str):
        self.table = cache(lambda name: spark.read.parquet(f"{folder}/{name}.parquet"))
        self._applied = cache(partial(_applied, self.table))
        self.lending = Lazy(
            {
                "customers": lambda: customers(self.table),
                "bureau_features": lambda: bureau_features(self.table),
                "loan_applications": lambda: _applications(self.table).drop("o_orderkey", "order_day"),
                "disbursements": lambda: disbursements(self._applied()),
                "repayments": lambda: repayments(self.table, self._applied()),
                "collection_calls": lambda: collection_calls(self.table),
            }
        )

    def repayments_by_loan(self, parts: int) -> DataFrame:
        """The repayments, dealt by loan to ``parts`` partitions."""
        return repayments(self.table, self._applied(), parts)

    def questions(self) -> DataFrame:
        """One question per event; the kind of event decides which of the demo questions it asks."""
        return self.table("events").selectExpr("event_id", f"{_mapped('event_type', QUESTION_OF_EVENT)} AS question")

    def conversations(self) -> DataFrame:
        """What people wrote in conversations, as questions."""
        return self.table("conversations").selectExpr("conv_id", "turn", "role", "text AS question")

    def passages_to_find(self) -> DataFrame:
        """The benchmark passages as questions to the documents."""
        return self.table("benchmark").selectExpr("CAST(item_id AS STRING) AS question_id", "text AS question")


def customers(table) -> DataFrame:
    places = table("nation").join(table("region"), table("nation")["n_regionkey"] == table("region")["r_regionkey"])
    people = table("customer").selectExpr(
        "*", "CAST((FLOOR(c_acctbal) + 1000) * 10 + 12000 AS DOUBLE) AS monthly_income"
    )
    return people.join(places, people["c_nationkey"] == places["n_nationkey"]).select(
        F.expr("CAST(c_custkey AS STRING) AS customer_id"),
        F.expr("r_name AS state"),
        F.expr("n_name AS city"),
        F.expr("CAST(c_custkey % 41 + 21 AS INT) AS age"),
        F.expr(f"{_mapped('c_mktsegment', EMPLOYMENT)} AS employment_type"),
        "monthly_income",
        income_segment(F.col("monthly_income")).alias("credit_segment"),
        F.expr("DATE_ADD(DATE '2025-01-01', CAST(c_custkey % 500 AS INT)) AS created_at"),
    )


def bureau_features(table) -> DataFrame:
    """Customers in debt have a record without a score."""
    return table("customer").selectExpr(
        "CAST(c_custkey AS STRING) AS customer_id",
        "IF(c_acctbal >= 0, CAST(FLOOR(c_acctbal * 0.06D) + 300 AS INT), NULL) AS bureau_score",
        "CAST(c_custkey % 10 AS INT) AS active_loans",
        "c_custkey % 101 / 100D AS credit_utilization",
        "CAST(c_custkey % 9 AS INT) AS enquiries_3m",
        "CAST(c_custkey DIV 6 % 4 AS INT) AS delinq_12m",
    )


def _applications(table) -> DataFrame:
    """Applications of twelve months, with the columns of the order that the instalments need."""
    return (
        table("orders")
        .selectExpr(
            "*",
            "FLOOR(o_totalprice / 100D) / 10D + 100D AS risk_score",
            "o_totalprice + 25000D AS requested_amount",
            "o_orderstatus = 'F' AS approved",
            "CAST(o_orderdate AS DATE) AS order_day",
        )
        .selectExpr(
            "o_orderkey",
            "order_day",
            "CAST(o_orderkey AS STRING) AS app_id",
            "CAST(o_custkey AS STRING) AS customer_id",
            "DATE_ADD(DATE '2025-07-01', DATEDIFF(order_day, DATE '1992-01-01') % 365) AS application_date",
            f"{_mapped('o_orderpriority', PRODUCT)} AS product",
            "requested_amount",
            "ELEMENT_AT(ARRAY(6, 9, 12, 18, 24, 36), CAST(o_orderkey % 6 + 1 AS INT)) AS tenure_months",
            "ELEMENT_AT(ARRAY('App', 'Branch', 'Partner', 'Referral'), CAST(o_orderkey % 4 + 1 AS INT)) AS channel",
            "IF(approved, 'Approved', 'Rejected') AS approval_status",
            "CASE WHEN approved THEN NULL WHEN risk_score > 330 THEN 'Policy score cutoff' "
            "ELSE 'Affordability policy' END AS rejection_reason",
            "IF(approved, CAST(FLOOR(requested_amount) AS DOUBLE), 0D) AS approved_amount",
            "IF(approved, FLOOR((risk_score / 40D + 12D) * 100D) / 100D, 0D) AS interest_rate",
            "risk_score",
        )
    )


def _applied(table) -> DataFrame:
    """Applications with the id and the payout day that their loan has if they are approved."""
    return _applications(table).selectExpr(
        "*", "app_id AS loan_id", "DATE_ADD(application_date, CAST(o_orderkey % 6 + 1 AS INT)) AS disbursed_date"
    )


def disbursements(applied: DataFrame) -> DataFrame:
    return applied.filter("approval_status = 'Approved'").selectExpr(
        "loan_id",
        "app_id",
        "customer_id",
        "disbursed_date",
        "approved_amount AS principal",
        "tenure_months",
        "interest_rate",
        "risk_score",
    )


def repayments(table, applied: DataFrame, parts: int | None = None) -> DataFrame:
    """Every line. The largest lines with the largest discount were never paid.

    Lines meet their order by the loan's id, so that joins and groups by loan that follow need no second
    shuffle. ``parts``: the rows come dealt by that id to so many partitions, for a table that is laid out so.
    """
    lines = table("lineitem").selectExpr(
        "CAST(l_orderkey AS STRING) AS loan_id",
        "l_linenumber",
        "l_extendedprice",
        "l_discount",
        "l_quantity",
        "CAST(l_shipdate AS DATE) AS ship_day",
    )
    orders = applied.select("loan_id", "order_day", "disbursed_date")
    if parts:
        lines, orders = lines.repartition(parts, "loan_id"), orders.repartition(parts, "loan_id")
    return (
        lines.join(orders, "loan_id")
        .selectExpr(
            "*",
            "GREATEST(DATEDIFF(ship_day, order_day), 0) % 121 AS dpd",
            "ADD_MONTHS(TRUNC(disbursed_date, 'month'), l_linenumber) AS due_date",
        )
        .selectExpr(
            "loan_id",
            "due_date",
            "DATE_ADD(due_date, dpd) AS paid_date",
            "l_linenumber AS mob",
            "l_extendedprice AS due_amount",
            "CASE WHEN l_quantity = 50 AND l_discount >= 0.095D THEN NULL "
            "ELSE FLOOR(l_extendedprice * (1D - l_discount) * 100D + 0.5D) / 100D END AS paid_amount",
            "dpd",
        )
    )


def collection_calls(table) -> DataFrame:
    """Every event is a call about the loan of its own number, if there is one."""
    return table("events").selectExpr(
        "CAST(event_id AS STRING) AS call_id",
        "CAST(event_id AS STRING) AS loan_id",
        "CAST(ts AS DATE) AS call_date",
        "event_type AS outcome",
        "props AS agent_notes",
    )
