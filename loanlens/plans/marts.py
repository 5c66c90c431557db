"""The reporting marts. ``t`` maps the names of the typed lending tables to DataFrames."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlens.functions.lending import dpd_bucket, is_30_plus, is_approved, month_of, risk_band
from loanlens.functions.numbers import avg_score, percent, round_half_up, sum_money
from loanlens.lazy import Lazy

Tables = Mapping[str, DataFrame]


def loan_features(t: Tables) -> DataFrame:
    """One row per disbursement with its application, customer and, if any, bureau attributes.

    Customers meet their bureau rows first: both sides are keyed by customer,
    and the loans then need one join on that key instead of two.
    """
    loans = t["disbursements"]
    applications = t["loan_applications"].select("app_id", "product", "channel")
    profile = (
        t["customers"]
        .select("customer_id", "state", "city", "employment_type", "credit_segment")
        .join(t["bureau_features"], "customer_id", "left")
    )
    return loans.join(applications, "app_id").join(profile, "customer_id").select(
        "loan_id",
        "app_id",
        "customer_id",
        "disbursed_date",
        month_of(F.col("disbursed_date")).alias("disbursed_month"),
        "state",
        "city",
        "employment_type",
        "credit_segment",
        "product",
        "channel",
        "principal",
        "tenure_months",
        "interest_rate",
        "risk_score",
        "bureau_score",
        "active_loans",
        "credit_utilization",
        "enquiries_3m",
        "delinq_12m",
        risk_band(F.col("risk_score")).alias("risk_band"),
    )


def repayment_enriched(repayments: DataFrame, features: DataFrame) -> DataFrame:
    """Every repayment, with its loan where there is one. Hot loans are left to adaptive joins."""
    loans = features.select(
        "loan_id",
        "disbursed_month",
        "state",
        "city",
        "employment_type",
        "credit_segment",
        "product",
        "channel",
        "principal",
        "risk_band",
    )
    return (
        repayments.join(loans, "loan_id", "left")
        .withColumn("dpd_bucket", dpd_bucket(F.col("dpd")))
        .withColumn("is_30_plus_dpd", is_30_plus(F.col("dpd")))
    )


def approval_funnel(t: Tables) -> DataFrame:
    applications = t["loan_applications"].select(
        "customer_id",
        month_of(F.col("application_date")).alias("application_month"),
        "product",
        "channel",
        is_approved(F.col("approval_status")).alias("approved"),
        "risk_score",
        F.col("approved_amount").alias("amount"),
    )
    applicants = t["customers"].select("customer_id", "employment_type", "credit_segment")
    approved = F.sum("approved")
    return (
        applications.join(applicants, "customer_id", "left")
        .groupBy("application_month", "product", "channel", "employment_type", "credit_segment")
        .agg(
            F.count(F.lit(1)).alias("applications"),
            approved.alias("approved_applications"),
            round_half_up(percent(approved, F.count(F.lit(1))), 2).alias("approval_rate_pct"),
            round_half_up(avg_score(F.col("risk_score")), 2).alias("avg_risk_score"),
            sum_money(F.col("amount")).alias("approved_amount"),
        )
    )


def portfolio_summary(features: DataFrame) -> DataFrame:
    return features.groupBy("disbursed_month", "product", "channel", "risk_band").agg(
        F.count_distinct("loan_id").alias("loans"),
        round_half_up(sum_money(F.col("principal")), 2).alias("principal_disbursed"),
        round_half_up(avg_score(F.col("risk_score")), 2).alias("avg_risk_score"),
        round_half_up(avg_score(F.col("bureau_score")), 2).alias("avg_bureau_score"),
    )


def dpd_bucket_analysis(enriched: DataFrame) -> DataFrame:
    """The bucket is part of the key, so the 30+ rate is 0 or 100 except in the bucket that ends at 30."""
    return enriched.groupBy(
        month_of(F.col("due_date")).alias("due_month"), "product", "channel", "risk_band", "dpd_bucket"
    ).agg(
        F.count(F.lit(1)).alias("scheduled_instalments"),
        round_half_up(sum_money(F.col("due_amount")), 2).alias("amount_due"),
        round_half_up(sum_money(F.coalesce("paid_amount", F.lit(0.0))), 2).alias("amount_paid"),
        round_half_up(percent(F.sum("is_30_plus_dpd"), F.count(F.lit(1))), 2).alias("thirty_plus_dpd_rate_pct"),
    )


def vintage_analysis(enriched: DataFrame) -> DataFrame:
    """Repayments without a loan form a group of their own with a missing month and band."""
    return enriched.groupBy("disbursed_month", "mob", "risk_band").agg(
        F.count_distinct("loan_id").alias("loans_observed"),
        round_half_up(percent(F.sum("is_30_plus_dpd"), F.count(F.lit(1))), 2).alias("thirty_plus_dpd_rate_pct"),
    )


def gold(t: Tables) -> Lazy:
    """All six marts as one graph; ``jobs.build_all`` writes and reads back the two shared ones."""
    marts = Lazy(
        {
            "gold_loan_features": lambda: loan_features(t),
            "gold_repayment_enriched": lambda: repayment_enriched(t["repayments"], marts["gold_loan_features"]),
            "gold_approval_funnel": lambda: approval_funnel(t),
            "gold_portfolio_summary": lambda: portfolio_summary(marts["gold_loan_features"]),
            "gold_dpd_bucket_analysis": lambda: dpd_bucket_analysis(marts["gold_repayment_enriched"]),
            "gold_vintage_analysis": lambda: vintage_analysis(marts["gold_repayment_enriched"]),
        }
    )
    return marts
