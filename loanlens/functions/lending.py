"""Column rules of the lending marts.

NULL handling follows SQL ``CASE``: a comparison with NULL is not true, so a
missing score or a missing days-past-due lands in the last branch.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels and limits that the marts share with their consumers.
RISK_BANDS = [(220, "Low"), (300, "Medium"), (380, "High")]
RISK_BAND_LAST = "Very High"
DPD_BUCKETS = [
    (0, 0, "0 Current"),
    (1, 30, "1-30 Early"),
    (31, 60, "31-60 Moderate"),
    (61, 90, "61-90 Severe"),
]
DPD_BUCKET_LAST = "90+ Critical"
LATE_BUCKETS = ["31-60 Moderate", "61-90 Severe", "90+ Critical"]
INCOME_SEGMENTS = [(0, 25_000, "Mass"), (25_000, 50_000, "Emerging"), (50_000, 90_000, "Prime"), (90_000, 10_000_000, "Affluent")]
APPROVED = "Approved"
REJECTION_REASONS = [
    "Low bureau score",
    "Recent delinquency",
    "High recent enquiries",
    "Policy score cutoff",
    "Affordability policy",
]


def _ladder(branches: list[tuple[Column, str]], last: Column) -> Column:
    (first, label), *rest = branches
    out = F.when(first, label)
    for condition, label in rest:
        out = out.when(condition, label)
    return out.otherwise(last)


def month_of(date: Column) -> Column:
    return F.trunc(date, "month")


def risk_band(score: Column) -> Column:
    return _ladder([(score < limit, label) for limit, label in RISK_BANDS], F.lit(RISK_BAND_LAST))


def dpd_bucket(dpd: Column) -> Column:
    return _ladder([(dpd.between(lo, hi), label) for lo, hi, label in DPD_BUCKETS], F.lit(DPD_BUCKET_LAST))


def is_30_plus(dpd: Column) -> Column:
    return F.when(dpd >= 30, 1).otherwise(0)


def is_approved(status: Column) -> Column:
    return F.when(status == APPROVED, 1).otherwise(0)


def income_segment(income: Column) -> Column:
    """Right-closed bins; an income outside all of them has no segment."""
    return _ladder(
        [((income > lo) & (income <= hi), label) for lo, hi, label in INCOME_SEGMENTS],
        F.lit(None).cast("string"),
    )


def base_risk_score(bureau: Column, delinquencies: Column, enquiries: Column, utilization: Column, employment: Column) -> Column:
    """Higher is riskier."""
    return (
        900.0
        - bureau
        + 45.0 * delinquencies
        + 18.0 * enquiries
        + 75.0 * utilization
        + F.when(employment == "Gig worker", 35.0).otherwise(0.0)
        + F.when(employment == "Self-employed", 18.0).otherwise(0.0)
    )


def clipped_score(score: Column) -> Column:
    """Kept within 50..700, one decimal, ties to even. A missing score stays missing."""
    bounded = F.when(score < 50.0, 50.0).when(score > 700.0, 700.0).otherwise(score)
    return F.rint(bounded * 10.0) / 10.0


def rejection_reason(bureau: Column, delinquencies: Column, enquiries: Column, score: Column) -> Column:
    low, delinquent, many, cutoff, other = REJECTION_REASONS
    return _ladder(
        [(bureau < 580, low), (delinquencies > 1, delinquent), (enquiries > 4, many), (score > 330, cutoff)],
        F.lit(other),
    )
