from datetime import date

import pytest
from pyspark.sql import functions as F

from lending import portfolio
from loanlens.plans import policy, quality
from loanlens.sources.tables import columns_of


@pytest.fixture(scope="module")
def t(spark):
    return portfolio(spark)


def test_contract(t):
    broken = {**t, "customers": t["customers"].drop("city").unionByName(t["customers"].drop("city").limit(1))}
    got = {(r["table_name"], r["requirement"], r["name"]): r["violations"] for r in policy.contract_check(broken).collect()}
    assert got["customers", "column", "city"] == 1 and got["customers", "column", "state"] == 0
    assert got["customers", "primary_key", "customer_id"] == 1
    assert got["loan_applications", "foreign_key", "customer_id"] == 2
    assert len(got) == 8 + 1 + 12 + 1 + 1


def test_contract_without_its_key(t):
    got = policy.contract_check({**t, "customers": t["customers"].withColumnRenamed("customer_id", "id"), "loan_applications": t["loan_applications"]},
                                {"customers": policy.CONTRACTS["customers"]})
    assert got.filter("requirement = 'primary_key'").first()["violations"] == 3


def test_schema_drift(t):
    changed = t["customers"].withColumn("age", F.col("age").cast("long")).drop("city").withColumn("extra", F.lit("x"))
    got = {r["column_name"]: (r["drift"], r["found"], r["filled"]) for r in
           policy.schema_drift({"customers": changed}, {"customers": columns_of("customers")}).collect()}
    assert got["age"] == ("type", "bigint", 3) and got["city"] == ("missing", None, 0)
    assert got["extra"] == ("unexpected", "string", 3) and got["state"] == ("none", "string", 2)


def test_freshness(t):
    got = {r["table_name"]: r for r in policy.freshness({**t, "collection_calls": t["collection_calls"].filter("false")}, F.lit(date(2026, 7, 31))).collect()}
    assert (got["repayments"]["newest"], got["repayments"]["days_old"], got["repayments"]["status"]) == (date(2026, 7, 1), 30, "PASS")
    assert got["customers"]["status"] == got["collection_calls"]["status"] == "FAIL"


def test_orphan_rates(t):
    got = {(r["table_name"], r["key"]): (r["row_count"], r["orphans"], r["orphan_pct"], r["status"]) for r in policy.orphan_rates(t).collect()}
    assert got["loan_applications", "customer_id"] == (7, 2, 28.571, "FAIL")
    assert got["disbursements", "app_id"] == (5, 0, 0.0, "PASS")
    assert got["repayments", "loan_id"][1] == 2


def test_roll_matrix(t, rows):
    data = [("l", m, date(2026, m, 1), d) for m, d in enumerate([0, 10, 40, 40, 5], 1)] + [(None, 1, date(2026, 1, 1), 0)] * 2 + [("k", 1, None, 0)]
    got = {(r["from_bucket"][0], r["to_bucket"][0], r["movement"]): r["instalments"]
           for r in policy.roll_matrix(rows(data, "loan_id string, mob int, due_date date, dpd int")).collect()}
    assert got == {("0", "1", "forward"): 1, ("1", "3", "forward"): 1, ("3", "3", "same"): 1, ("3", "1", "back"): 1}


def test_collection_priority(t, spark):
    late = spark.createDataFrame([("l3", date(2026, 7, 1), None, m, 100.0, 1.0, 45) for m in (1, 2)] + [("l4", date(2026, 7, 1), None, 1, 9.0, None, 29)],
                                 t["repayments"].schema)
    calls = spark.createDataFrame([("k", "l1", None, "Promise to pay", None)], t["collection_calls"].schema)
    got = policy.collection_priority({**t, "repayments": t["repayments"].unionByName(late), "collection_calls": calls}).collect()
    assert [(r["loan_id"], r["points"], r["outstanding"], r["late_instalments"], r["failed_promises"]) for r in got] == [
        ("l1", 2, 90.0, 6, 1), ("l3", 2, 499998.0, 2, 0)] or [r["loan_id"] for r in got] == ["l3", "l1"]
    assert {r["loan_id"]: r["points"] for r in got} == {"l1": 2, "l3": 2}


def test_decisions(t):
    got = {r["app_id"]: r["decision"] for r in policy.policy_decisions(t).collect()}
    assert got["a1"] == policy.REVIEW  # 700 is fair
    assert got["a3"] == policy.DECLINE and got["a6"] == policy.REVIEW
    better = {**t, "bureau_features": t["bureau_features"].withColumn("bureau_score", F.lit(750)).withColumn("credit_utilization", F.lit(0.1))}
    assert {r["app_id"]: r["decision"] for r in policy.policy_decisions(better).collect()}["a1"] == policy.PREFERRED
    weak = {**t, "loan_applications": t["loan_applications"].withColumn("requested_amount", F.lit(1e9))}
    assert {r["app_id"]: r["decision"] for r in policy.policy_decisions(weak).collect()}["a1"] == policy.DECLINE


def test_approval_rates(t):
    rows = policy.approval_rates(t).collect()
    total = next(r for r in rows if r["grouping_id"] == 15)
    assert (total["applications"], total["approved"], total["approval_rate_pct"]) == (7, 4, 57.14)
    channels = {r["channel"]: r["applications"] for r in rows if r["grouping_id"] == 7}
    assert channels == {"App": 4, "Partner": 1, "Branch": 2}


def test_incidents(t):
    got = policy.incidents(quality.report(t)).collect()
    assert len(got) == quality.listing(quality.report(t)).count()
    assert all(r["suspected_cause"] != "Unknown" and r["owner_action"] for r in got)
