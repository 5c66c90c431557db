"""The standing questions about the portfolio, asked of the marts.

Ties under a limit are settled by the group keys, so a rerun returns the same rows.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.functions.lending import LATE_BUCKETS
from loanlens.functions.numbers import avg_score, percent, round_half_up, sum_money

Tables = Mapping[str, DataFrame]


def portfolio_top(summary: DataFrame, limit: int = 12) -> DataFrame:
    return summary.orderBy(
        F.desc_nulls_last("disbursed_month"),
        F.desc_nulls_last("principal_disbursed"),
        F.asc_nulls_last("product"),
        F.asc_nulls_last("channel"),
        F.asc_nulls_last("risk_band"),
    ).limit(limit)


def approval_drop(funnel: DataFrame, limit: int = 10) -> DataFrame:
    """Where the approval rate fell between the two newest months.

    The funnel is cut to those two months before it is aggregated, and both
    months are laid side by side by conditional aggregates: one shuffle, and no
    join of the result with itself. A segment missing in either month drops
    out. The mean risk score is the plain mean over the funnel rows.
    """
    months = funnel.select("application_month").distinct().orderBy(F.desc_nulls_last("application_month")).limit(2)
    newest = months.agg(F.sort_array(F.collect_list(F.struct("application_month")), asc=False)).scalar()
    latest_month = F.get(newest, F.lit(0))["application_month"]
    month_before = F.get(newest, F.lit(1))["application_month"]

    month = F.col("application_month")
    segment_known = F.col("channel").isNotNull() & F.col("employment_type").isNotNull()
    recent = funnel.filter(
        segment_known & (F.size(newest) == 2) & (month.eqNullSafe(latest_month) | month.eqNullSafe(month_before))
    ).withColumn("latest", month.eqNullSafe(latest_month))

    def side(latest: bool, value: str) -> Column:
        return F.when(F.col("latest") == latest, F.col(value))

    def rate(latest: bool) -> Column:
        share = F.try_divide(F.lit(100.0) * F.sum(side(latest, "approved_applications")), F.sum(side(latest, "applications")))
        return round_half_up(share, 2)

    drop = F.col("previous_approval_rate_pct") - F.col("latest_approval_rate_pct")
    return (
        recent.groupBy("channel", "employment_type")
        .agg(
            F.max(F.when(F.col("latest"), F.col("application_month"))).alias("latest_month"),
            rate(False).alias("previous_approval_rate_pct"),
            rate(True).alias("latest_approval_rate_pct"),
            round_half_up(avg_score(side(False, "avg_risk_score")), 2).alias("previous_avg_risk_score"),
            round_half_up(avg_score(side(True, "avg_risk_score")), 2).alias("latest_avg_risk_score"),
            F.sum(side(True, "applications")).alias("latest_applications"),
        )
        .filter(drop > 0)
        .select(
            "latest_month",
            "channel",
            "employment_type",
            "previous_approval_rate_pct",
            "latest_approval_rate_pct",
            round_half_up(drop, 2).alias("approval_drop_pp"),
            "previous_avg_risk_score",
            "latest_avg_risk_score",
            "latest_applications",
        )
        .orderBy(F.desc("approval_drop_pp"), F.desc("latest_applications"), "channel", "employment_type")
        .limit(limit)
    )


def delinquency(buckets: DataFrame, limit: int = 10) -> DataFrame:
    """Segments with the highest 30+ rate; the rate is the plain mean over the segment's buckets."""
    late = F.when(F.col("dpd_bucket").isin(LATE_BUCKETS), F.col("amount_due")).otherwise(0.0)
    return (
        buckets.groupBy("due_month", "product", "channel", "risk_band")
        .agg(
            round_half_up(sum_money(late), 2).alias("amount_30_plus_due"),
            round_half_up(avg_score(F.col("thirty_plus_dpd_rate_pct")), 2).alias("avg_30_plus_dpd_rate_pct"),
            F.sum("scheduled_instalments").alias("instalments"),
        )
        .orderBy(
            F.desc_nulls_last("avg_30_plus_dpd_rate_pct"),
            F.desc_nulls_last("amount_30_plus_due"),
            F.asc_nulls_last("due_month"),
            F.asc_nulls_last("product"),
            F.asc_nulls_last("channel"),
            F.asc_nulls_last("risk_band"),
        )
        .limit(limit)
    )


def row_counts(marts: Tables, checks: DataFrame) -> DataFrame:
    """Rows per mart, and the number of data-quality checks."""
    counted = {**marts, "gold_data_quality_report": checks, "dq_checks": checks}
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in counted.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def run_sql(spark: SparkSession, text: str, marts: Tables) -> DataFrame:
    """Any SQL text, with every mart that it names visible under its own name."""
    named = {name: marts[name] for name in marts if re.search(rf"\b{name}\b", text)}
    for name, df in named.items():
        df.createOrReplaceTempView(name)
    try:
        return spark.sql(text)
    finally:
        for name in named:
            spark.catalog.dropTempView(name)
