from datetime import date

import pytest

from lending import portfolio
from loanlens.plans import quality
from loanlens.sources.tables import SCHEMAS


@pytest.fixture(scope="module")
def report(spark):
    return {(r["table_name"], r["rule_name"]): r for r in quality.report(portfolio(spark)).collect()}


def test_one_row_per_check(report):
    assert len(report) == 30


def test_null_rates(report):
    state = report["customers", "null_rate_state"]
    assert (state["status"], state["severity"], state["metric_value"]) == ("FAIL", "HIGH", 33.333)
    assert state["details"] == "1 nulls out of 3 rows"
    assert report["customers", "null_rate_age"]["severity"] == "LOW"


def test_missing_keys_count_as_duplicates(report):
    calls = report["collection_calls", "duplicate_primary_key_call_id"]
    assert (calls["metric_value"], calls["severity"]) == (2.0, "CRITICAL")
    assert calls["details"] == "Duplicate call_id rows: 2"


def test_a_key_three_times_is_one_duplicate_key(report):
    schedule = report["repayments", "duplicate_repayment_schedule_key"]
    assert (schedule["metric_value"], schedule["severity"]) == (1.0, "HIGH")


def test_missing_foreign_keys_are_orphans(report):
    assert report["loan_applications", "fk_customer_id_exists"]["metric_value"] == 2.0
    assert report["repayments", "fk_loan_id_exists"]["metric_value"] == 2.0
    assert report["repayments", "fk_loan_id_exists"]["severity"] == "CRITICAL"


def test_outliers_leave_out_missing_amounts(report):
    assert report["disbursements", "principal_outlier_threshold"]["metric_value"] == 2.0


def test_monthly_drop(report):
    drop = report["loan_applications", "approval_rate_monthly_drop_gt_5pp"]
    assert (drop["status"], drop["metric_value"]) == ("FAIL", 75.0)
    assert drop["details"] == "Latest approval rate 25.00% vs previous 100.00%; drop=75.00pp"


def applications(spark, months):
    """(month, approved, rejected) per entry."""
    data = []
    for month, approved, rejected in months:
        for i in range(approved + rejected):
            status = "Approved" if i < approved else "Rejected"
            data.append((f"{month}-{i}", "c", date(2026, month, 1), "P", 1.0, 6, "App", status, None, 0.0, 0.0, 1.0))
    return spark.createDataFrame(data, SCHEMAS["loan_applications"])


@pytest.mark.parametrize(
    ("months", "status", "metric"),
    [
        ([(6, 3, 1)], "PASS", 0.0),
        ([(5, 10, 10), (6, 9, 11)], "PASS", 5.0),
        ([(5, 100, 100), (6, 179, 221)], "FAIL", 5.25),
        ([(5, 1, 9), (6, 9, 1)], "PASS", -80.0),
    ],
)
def test_drop_threshold(spark, months, status, metric):
    row = quality.check("approval_monthly_drop", {"loan_applications": applications(spark, months)}).first()
    assert (row["status"], row["metric_value"]) == (status, metric)
    assert (row["details"] == "Insufficient history") == (len(months) == 1)


def test_null_rate_limit_and_empty_table(spark):
    def rate(n_rows, n_null):
        t = portfolio(spark)
        data = [(None if i < n_null else "c", 1, 1, 0.1, 1, 1) for i in range(n_rows)]
        t["bureau_features"] = spark.createDataFrame(data, SCHEMAS["bureau_features"])
        got = quality.check("null_rates", t).filter("rule_name = 'null_rate_customer_id' AND table_name = 'bureau_features'")
        return tuple(got.first())[2:]

    assert rate(20, 1) == ("PASS", "LOW", 5.0, "1 nulls out of 20 rows")
    assert rate(19, 1) == ("FAIL", "HIGH", 5.263, "1 nulls out of 19 rows")
    assert rate(0, 0) == ("PASS", "LOW", 0.0, "0 nulls out of 0 rows")


def test_key_check_of_an_empty_table_stays_in_the_report(spark):
    t = portfolio(spark)
    t["collection_calls"] = t["collection_calls"].filter("false")
    assert quality.check("primary_key_duplicates", t).count() == 4


def test_listing_and_histogram(spark):
    checks = quality.report(portfolio(spark))
    failures = quality.listing(checks).collect()
    assert [r["severity"] for r in failures] == sorted((r["severity"] for r in failures))
    assert {r["status"] for r in failures} == {"FAIL"}
    assert quality.listing(checks, only_failures=False).count() == 30
    counts = {r["severity"]: r["failed_checks"] for r in quality.failures_by_severity(checks).collect()}
    assert sum(counts.values()) == len(failures)
