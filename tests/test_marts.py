from datetime import date

from pyspark.sql import functions as F

from lending import DPD, portfolio
from loanlens.functions.lending import income_segment
from loanlens.plans import analysis, derive, marts


def by(df, *keys):
    return {tuple(r[k] for k in keys): r for r in df.collect()}


def test_loan_features_bands_and_missing_bureau(spark):
    got = by(marts.loan_features(portfolio(spark)), "loan_id")
    bands = {k[0]: r["risk_band"] for k, r in got.items()}
    assert bands == {"l1": "Low", "l2": "Medium", "l3": "High", "l4": "Very High", "l5": "Very High"}
    assert got["l4",]["bureau_score"] is None and got["l1",]["bureau_score"] == 700
    assert got["l3",]["disbursed_month"] == date(2026, 5, 1)
    assert len(got["l1",]) == 21


def test_dpd_buckets_and_flag_keep_their_disagreement_at_30(spark):
    t = portfolio(spark)
    enriched = marts.repayment_enriched(t["repayments"], marts.loan_features(t))
    got = {r["mob"]: (r["dpd_bucket"], r["is_30_plus_dpd"]) for r in enriched.filter("loan_id = 'l1'").collect()}
    labels = ["0 Current", "1-30 Early", "1-30 Early", "31-60 Moderate", "31-60 Moderate", "61-90 Severe", "61-90 Severe"]
    assert [got[i + 1][0] for i in range(len(DPD))] == [*labels, *["90+ Critical"] * 3]
    assert [got[i + 1][1] for i in range(len(DPD))] == [0, 0, 1, 1, 1, 1, 1, 1, 0, 0]
    assert enriched.count() == t["repayments"].count()


def test_funnel_counts_applications_without_customer(spark):
    got = by(marts.approval_funnel(portfolio(spark)), "application_month", "channel", "employment_type")
    june = got[date(2026, 6, 1), "App", "Salaried"]
    assert (june["applications"], june["approved_applications"], june["approval_rate_pct"]) == (2, 1, 50.0)
    assert june["approved_amount"] == 600.0 and june["avg_risk_score"] == 390.0
    unknown = got[date(2026, 6, 1), "Branch", None]
    assert unknown["applications"] == 2 and unknown["avg_risk_score"] == 100.0


def test_aggregating_marts(spark):
    t = portfolio(spark)
    gold = marts.gold(t)
    summary = by(gold["gold_portfolio_summary"], "disbursed_month", "risk_band")
    assert summary[date(2026, 6, 1), "Very High"]["loans"] == 2
    assert summary[date(2026, 6, 1), "Very High"]["avg_bureau_score"] == 700.0
    buckets = by(gold["gold_dpd_bucket_analysis"], "due_month", "risk_band", "dpd_bucket")
    early = buckets[date(2026, 6, 1), "Low", "1-30 Early"]
    assert (early["scheduled_instalments"], early["thirty_plus_dpd_rate_pct"]) == (2, 50.0)
    assert buckets[date(2026, 6, 1), "Low", "61-90 Severe"]["amount_paid"] == 90.0
    assert buckets[date(2026, 7, 1), None, "31-60 Moderate"]["amount_due"] == 10.0
    vintage = by(gold["gold_vintage_analysis"], "disbursed_month", "mob", "risk_band")
    assert vintage[date(2026, 5, 1), 1, "Medium"]["loans_observed"] == 1
    assert vintage[None, 2, None]["loans_observed"] == 1  # the missing loan id is not counted
    assert vintage[None, 2, None]["thirty_plus_dpd_rate_pct"] == 50.0


def test_no_fact_table_passes_through_one_task(spark):
    """Plans of the marts have no exchange into a single partition, and read each line once."""
    import __spark_entry__ as registry

    for name in ("gold_loan_features", "gold_repayment_enriched", "gold_approval_funnel", "gold_portfolio_summary",
                 "gold_dpd_bucket_analysis", "gold_vintage_analysis"):
        plan = registry.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "SinglePartition" not in plan, name
        if name == "gold_repayment_enriched":
            assert plan.count("l_linenumber") and plan.count("lineitem.parquet") == 1


def test_approval_drop(spark, rows):
    schema = "application_month date, channel string, employment_type string, applications long, approved_applications long, avg_risk_score double"
    april, may, june = (date(2026, m, 1) for m in (4, 5, 6))
    data = [
        (april, "App", "Salaried", 10, 1, 1.0),
        (may, "App", "Salaried", 10, 8, 200.0),
        (may, "App", "Salaried", 30, 22, 201.0),
        (june, "App", "Salaried", 20, 10, 210.0),
        (may, "Branch", "Salaried", 10, 5, 200.0),
        (june, "Branch", "Salaried", 10, 5, 200.0),
        (may, "Partner", "Salaried", 10, 9, 200.0),
        (june, "Referral", "Salaried", 10, 1, 200.0),
        (may, None, "Salaried", 10, 9, 200.0),
        (june, None, "Salaried", 10, 1, 200.0),
    ]
    got = analysis.approval_drop(rows(data, schema)).collect()
    assert [tuple(r) for r in got] == [(june, "App", "Salaried", 75.0, 50.0, 25.0, 200.5, 210.0, 20)]
    assert analysis.approval_drop(rows(data[:1], schema)).count() == 0


def test_delinquency_uses_the_plain_mean_over_buckets(spark, rows):
    schema = "due_month date, product string, channel string, risk_band string, dpd_bucket string, scheduled_instalments long, amount_due double, thirty_plus_dpd_rate_pct double"
    m = date(2026, 6, 1)
    data = [
        (m, "P", "App", "Low", "0 Current", 98, 10.0, 0.0),
        (m, "P", "App", "Low", "61-90 Severe", 2, 5.5, 100.0),
        (m, "P", "App", None, "1-30 Early", 1, 7.0, 50.0),
    ]
    got = [tuple(r)[3:] for r in analysis.delinquency(rows(data, schema)).collect()]
    assert got == [("Low", 5.5, 50.0, 100), (None, 0.0, 50.0, 1)]


def test_derivations(spark, rows):
    incomes = rows([(0.0,), (25000.0,), (25000.01,), (50000.0,), (90000.0,), (90001.0,), (None,)], "x double")
    labels = [r[0] for r in incomes.select(income_segment(F.col("x"))).collect()]
    assert labels == [None, "Mass", "Emerging", "Emerging", "Prime", "Affluent", None]

    t = portfolio(spark)
    scores = by(derive.risk_scores(t), "app_id")
    assert scores["a1",]["derived_risk_score"] == 237.5  # 200 + 75 * 0.5
    assert scores["a3",]["derived_risk_score"] == 573.8  # 340 + 90 + 90 + 18.75 + 35, tie to even
    assert len(scores) == 7 and scores["a6",]["derived_risk_score"] is None  # no customer, no score
    reasons = {r["app_id"]: r["derived_reason"] for r in derive.rejection_reasons(t).collect()}
    assert reasons["a1"] == "" and reasons["a4"] == "Policy score cutoff"

    loans = derive.disburse_approved(t["loan_applications"], F.lit(3))
    assert {r["loan_id"]: r["disbursed_date"] for r in loans.collect()}["a1"] == date(2026, 5, 5)

    plan = derive.repayment_schedule(t["disbursements"])
    tenures = {r["loan_id"]: r["tenure_months"] for r in t["disbursements"].collect()}
    assert {r["loan_id"]: r["count"] for r in plan.groupBy("loan_id").count().collect()} == tenures
    none = t["disbursements"].limit(1).withColumn("tenure_months", F.lit(None).cast("int"))
    assert [(r["mob"], r["due_date"], r["due_amount"]) for r in derive.repayment_schedule(none).collect()] == [(None, None, None)]
    assert derive.repayment_schedule(t["disbursements"], F.lit("2026-06-30").cast("date")).groupBy("loan_id").count().agg(F.max("count")).first()[0] == 1
    first = plan.filter("loan_id = 'l3' AND mob = 1").first()
    assert first["due_date"] == date(2026, 6, 1)
    assert first["due_amount"] == round(500000.0 / 12 * (1 + 20.0 / 1200), 2)

    calls = derive.overdue_call_list(t["repayments"]).collect()
    assert [r["dpd"] for r in calls] == [91, 90, 61, 60, 40, 31, 30, 1]
