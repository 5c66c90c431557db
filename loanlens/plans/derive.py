"""Tables that a lender derives from applications, bureau records and repayments."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.functions.lending import (
    base_risk_score,
    clipped_score,
    income_segment,
    is_approved,
    month_of,
    rejection_reason,
)
from loanlens.functions.numbers import round_half_even_exact

Tables = Mapping[str, DataFrame]


def customer_segments(customers: DataFrame) -> DataFrame:
    return customers.select("customer_id", "monthly_income", income_segment(F.col("monthly_income")).alias("credit_segment"))


def _applicants(t: Tables) -> DataFrame:
    """Applications with the employment of their customer and the customer's bureau record."""
    applications = t["loan_applications"].select(
        "app_id", "customer_id", "application_date", "channel", "approval_status", "risk_score"
    )
    people = (
        t["customers"].select("customer_id", "employment_type").join(t["bureau_features"].drop("active_loans"), "customer_id", "left")
    )
    return applications.join(people, "customer_id", "left")


def risk_scores(t: Tables) -> DataFrame:
    """The score rule. Applications without a customer or a bureau score have none."""
    base = base_risk_score(
        F.col("bureau_score"), F.col("delinq_12m"), F.col("enquiries_3m"), F.col("credit_utilization"), F.col("employment_type")
    )
    return _applicants(t).select("app_id", base.alias("base_score")).withColumn(
        "derived_risk_score", clipped_score(F.col("base_score"))
    )


def rejection_reasons(t: Tables) -> DataFrame:
    """First rule that applies; empty for approved applications. A missing value meets no rule."""
    reason = rejection_reason(F.col("bureau_score"), F.col("delinq_12m"), F.col("enquiries_3m"), F.col("risk_score"))
    approved = is_approved(F.col("approval_status")) == 1
    return _applicants(t).select("app_id", "approval_status", F.when(approved, "").otherwise(reason).alias("derived_reason"))


def disburse_approved(applications: DataFrame, lag_days: Column) -> DataFrame:
    """One loan per approved application, paid out ``lag_days`` later.

    The loan takes the id of its application: a running number would need all
    rows in one order.
    """
    return applications.filter(is_approved(F.col("approval_status")) == 1).select(
        F.col("app_id").alias("loan_id"),
        "app_id",
        "customer_id",
        F.date_add("application_date", lag_days).alias("disbursed_date"),
        F.col("approved_amount").alias("principal"),
        "tenure_months",
        "interest_rate",
        "risk_score",
    )


def repayment_schedule(disbursements: DataFrame, until: Column | None = None) -> DataFrame:
    """Every monthly instalment, due on the first of the month from the month after payout.

    A loan without a tenure has one row without a month, so that it shows.
    ``until`` leaves out what is due later.
    """
    amount = F.col("principal") / F.col("tenure_months") * (1.0 + F.col("interest_rate") / 1200.0)
    months = F.when(F.col("tenure_months") >= 1, F.sequence(F.lit(1), "tenure_months"))
    plan = (
        disbursements.withColumn("amount", F.when(F.col("tenure_months") >= 1, amount))
        .withColumn("mob", F.explode_outer(months))
        .select(
            "loan_id",
            F.add_months(month_of(F.col("disbursed_date")), F.col("mob")).alias("due_date"),
            "mob",
            round_half_even_exact("amount", 2).alias("due_amount"),
        )
    )
    return plan if until is None else plan.filter(F.col("due_date").isNull() | (F.col("due_date") <= until))


def overdue_call_list(repayments: DataFrame) -> DataFrame:
    """Every overdue instalment, the longest overdue first."""
    parts = ["loan_id", "due_date", "mob", "due_amount", "dpd"]
    return repayments.filter("dpd > 0").select(*parts).orderBy(F.desc("dpd"), "loan_id", "due_date", "mob")
