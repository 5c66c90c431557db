"""Data-quality rules. Each returns rows of the report:
``table_name, rule_name, status, severity, metric_value, details``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.functions.lending import is_approved, month_of
from loanlens.functions.numbers import fixed_text, percent, round_half_even_exact
from loanlens.operators.keys import duplicate_key_groups, orphan_count

Tables = Mapping[str, DataFrame]

# Which columns and keys are checked, and the limits.
NULL_CHECKED = {
    "customers": ["customer_id", "state", "age", "monthly_income"],
    "loan_applications": ["app_id", "customer_id", "application_date", "approval_status", "risk_score"],
    "disbursements": ["loan_id", "app_id", "customer_id", "principal"],
    "repayments": ["loan_id", "due_date", "due_amount", "paid_amount", "dpd"],
    "bureau_features": ["customer_id", "bureau_score", "delinq_12m"],
}
PRIMARY_KEYS = {
    "customers": "customer_id",
    "loan_applications": "app_id",
    "disbursements": "loan_id",
    "collection_calls": "call_id",
}
SCHEDULE_KEY = ["loan_id", "due_date", "mob"]
# Referring table: the table referred to, the key, and the wording.
REFERENCES = {
    "loan_applications": ("customers", "customer_id", "Applications with missing customer_id"),
    "repayments": ("disbursements", "loan_id", "Repayments with missing loan_id"),
}
MAX_NULL_PERCENT = 5
MAX_DROP_POINTS = 5
MAX_PRINCIPAL = 500_000
SEVERITY_ORDER = {"CRITICAL": 1, "HIGH": 2}


def _measured(rows: DataFrame, table: str, rule: str, severity: str, failed: str, metric: str, details: str) -> DataFrame:
    """Measurements as ``table_name, rule_name, worst, failed, metric_value, details``; all given as SQL."""
    return rows.selectExpr(
        f"{table} AS table_name",
        f"{rule} AS rule_name",
        f"{severity} AS worst",
        f"{failed} AS failed",
        f"CAST({metric} AS DOUBLE) AS metric_value",
        f"{details} AS details",
    )


def _graded(measured: list[DataFrame]) -> DataFrame:
    """A passed rule is always LOW; a failed one has the severity of its family."""
    return reduce(DataFrame.unionByName, measured).selectExpr(
        "table_name",
        "rule_name",
        "IF(failed, 'FAIL', 'PASS') AS status",
        "IF(failed, worst, 'LOW') AS severity",
        "metric_value",
        "details",
    )


NULLS, KEYS, OUTLIERS = "nulls", "keys", "outliers"


def _counts(t: Tables, table: str, kinds: Sequence[str]) -> DataFrame | None:
    """What one scan of a table tells: rows ``checked, total, kind, name, found``.

    Missing values per column, rows beyond the first of each key (rows without
    a key count as duplicates), and principals out of bounds.
    """
    found = {}
    if NULLS in kinds:
        found |= {(NULLS, c): f"COUNT_IF({c} IS NULL)" for c in NULL_CHECKED.get(table, [])}
    if KEYS in kinds and table in PRIMARY_KEYS:
        found[KEYS, PRIMARY_KEYS[table]] = f"COUNT(*) - COUNT(DISTINCT {PRIMARY_KEYS[table]})"
    if OUTLIERS in kinds and table == "disbursements":
        found[OUTLIERS, "principal"] = f"COUNT_IF(principal <= 0 OR principal > {MAX_PRINCIPAL})"
    if not found:
        return None
    measures = [F.expr(count).alias(f"n{i}") for i, count in enumerate(found.values())]
    cells = ", ".join(f"'{kind}', '{name}', n{i}" for i, (kind, name) in enumerate(found))
    return (
        t[table]
        .agg(F.expr("COUNT(*)").alias("total"), *measures)
        .selectExpr(f"'{table}' AS checked", "total", f"STACK({len(found)}, {cells}) AS (kind, name, found)")
    )


def _table_rules(t: Tables, *kinds: str) -> DataFrame:
    """The rules that need one table only, in one scan of each."""
    tables = dict.fromkeys([*NULL_CHECKED, *PRIMARY_KEYS])
    parts = [part for table in tables if (part := _counts(t, table, kinds)) is not None]
    return _rated(reduce(DataFrame.unionByName, parts))


def _rated(counts: DataFrame) -> DataFrame:
    rates = counts.selectExpr("*", "100D * found / GREATEST(total, 1) AS share").withColumn("rate", round_half_even_exact("share", 3))

    def by_kind(nulls: str, keys: str, outliers: str) -> str:
        return f"CASE kind WHEN '{NULLS}' THEN {nulls} WHEN '{KEYS}' THEN {keys} ELSE {outliers} END"

    return _measured(
        rates,
        "checked",
        by_kind("CONCAT('null_rate_', name)", "CONCAT('duplicate_primary_key_', name)", "'principal_outlier_threshold'"),
        by_kind("'HIGH'", "'CRITICAL'", "'HIGH'"),
        by_kind(f"rate > {MAX_NULL_PERCENT}", "found <> 0", "found <> 0"),
        by_kind("rate", "CAST(found AS DOUBLE)", "CAST(found AS DOUBLE)"),
        by_kind(
            "CONCAT(found, ' nulls out of ', total, ' rows')",
            "CONCAT('Duplicate ', name, ' rows: ', found)",
            f"'Principal should be between 0 and {MAX_PRINCIPAL}'",
        ),
    )


def _schedule_key_duplicates(t: Tables) -> DataFrame:
    """Counts the keys that occur more than once, not their surplus rows."""
    return _repeated(duplicate_key_groups(t["repayments"], SCHEDULE_KEY))


def _repeated(found: DataFrame) -> DataFrame:
    return _measured(
        found,
        "'repayments'",
        "'duplicate_repayment_schedule_key'",
        "'HIGH'",
        "repeated <> 0",
        "repeated",
        "CONCAT('Duplicate repayment schedule keys: ', repeated)",
    )


def _orphans(t: Tables, child: str) -> DataFrame:
    parent, key, _ = REFERENCES[child]
    return _orphaned(orphan_count(t[child], t[parent], key), child)


def _orphaned(found: DataFrame, child: str) -> DataFrame:
    _, key, details = REFERENCES[child]
    return _measured(found, f"'{child}'", f"'fk_{key}_exists'", "'CRITICAL'", "orphans <> 0", "orphans", f"'{details}'")


def _applications_without_customer(t: Tables) -> DataFrame:
    return _orphans(t, "loan_applications")


def _repayments_without_loan(t: Tables) -> DataFrame:
    return _orphans(t, "repayments")


def _approval_monthly_drop(t: Tables) -> DataFrame:
    """The newest month's approval rate against the month before it.

    The rows collapse to one per month first; only the two newest of those are
    gathered.
    """
    return _newest_drop(approvals_by_month(t["loan_applications"]))


def approvals_by_month(applications: DataFrame) -> DataFrame:
    """``month, approved, total``; applications without a date are a month of their own."""
    month = month_of(F.col("application_date")).alias("month")
    approved = F.sum(is_approved(F.col("approval_status")).cast("long")).alias("approved")
    return applications.groupBy(month).agg(approved, F.count(F.lit(1)).alias("total"))


def _newest_drop(months: DataFrame) -> DataFrame:
    monthly = months.select("month", percent(F.col("approved"), F.col("total")).alias("rate"))
    newest_two = monthly.orderBy(F.desc_nulls_last("month")).limit(2)
    change = (
        newest_two.agg(F.expr("SORT_ARRAY(COLLECT_LIST(STRUCT(month, rate)), false)").alias("r"))
        .selectExpr("GET(r, 0).rate AS latest", "GET(r, 1).rate AS previous")
        .selectExpr("*", "previous - latest AS change")
        .withColumn("drop", round_half_even_exact("change", 2))
        .withColumns({name: fixed_text(name, 2) for name in ("latest", "previous")})
    )
    return _measured(
        change,
        "'loan_applications'",
        "'approval_rate_monthly_drop_gt_5pp'",
        "'HIGH'",
        f"COALESCE(drop > {MAX_DROP_POINTS}, false)",
        "COALESCE(drop, 0D)",
        "COALESCE(CONCAT('Latest approval rate ', latest, '% vs previous ', previous, '%; drop=', "
        "CAST(drop AS DECIMAL(30,2)), 'pp'), 'Insufficient history')",
    )


RULES = {
    "null_rates": lambda t: _table_rules(t, NULLS),
    "primary_key_duplicates": lambda t: _table_rules(t, KEYS),
    "principal_outliers": lambda t: _table_rules(t, OUTLIERS),
    "schedule_key_duplicates": _schedule_key_duplicates,
    "applications_without_customer": _applications_without_customer,
    "repayments_without_loan": _repayments_without_loan,
    "approval_monthly_drop": _approval_monthly_drop,
}


def check(rule: str, t: Tables) -> DataFrame:
    """The report rows of one rule."""
    return _graded([RULES[rule](t)])


def report(t: Tables) -> DataFrame:
    """Every rule, one row per check; what one table can tell comes from one scan of it."""
    across = [_schedule_key_duplicates, _applications_without_customer, _repayments_without_loan, _approval_monthly_drop]
    return _graded([_table_rules(t, NULLS, KEYS, OUTLIERS), *[measure(t) for measure in across]])


def report_of(counts: DataFrame, repeated: DataFrame, orphans: Mapping[str, DataFrame], months: DataFrame) -> DataFrame:
    """The report from what was counted before: ``checked, total, kind, name, found``, one row ``repeated``,
    one row ``orphans`` per referring table, and ``month, approved, total``."""
    return _graded([_rated(counts), _repeated(repeated), *[_orphaned(found, child) for child, found in orphans.items()], _newest_drop(months)])


def severity_rank(severity: Column) -> Column:
    (first, one), (second, two) = SEVERITY_ORDER.items()
    return F.when(severity == first, one).when(severity == second, two).otherwise(3)


def listing(checks: DataFrame, only_failures: bool = True) -> DataFrame:
    """Most severe first."""
    wanted = checks.filter("status = 'FAIL'") if only_failures else checks
    return wanted.select("table_name", "rule_name", "status", "severity", "metric_value", "details").orderBy(
        severity_rank(F.col("severity")), "table_name", "rule_name"
    )


def failures_by_severity(checks: DataFrame) -> DataFrame:
    return checks.filter("status = 'FAIL'").groupBy("severity").agg(F.count(F.lit(1)).alias("failed_checks"))
