"""What the lender's written policies ask for beyond the marts: contracts, freshness, movements, priorities.

These are extensions: the policies describe them, and each is a Spark job here.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.functions.lending import dpd_bucket, is_approved, risk_band
from loanlens.functions.numbers import percent, round_half_even_exact, round_half_up, sum_money
from loanlens.operators.keys import orphan_count
from loanlens.operators.moves import steps
from loanlens.sources.tables import columns_of

Tables = Mapping[str, DataFrame]

# What the contracts and policies state.
CONTRACTS = {
    "customers": {
        "columns": ["customer_id", "state", "city", "age", "employment_type", "monthly_income", "credit_segment", "created_at"],
        "primary_key": "customer_id",
        "foreign_keys": {},
    },
    "loan_applications": {
        "columns": [
            "app_id", "customer_id", "application_date", "product", "requested_amount", "tenure_months", "channel",
            "approval_status", "rejection_reason", "approved_amount", "interest_rate", "risk_score",
        ],
        "primary_key": "app_id",
        "foreign_keys": {"customer_id": "customers"},
    },
}
DATED = {
    "customers": "created_at",
    "loan_applications": "application_date",
    "disbursements": "disbursed_date",
    "repayments": "due_date",
    "collection_calls": "call_date",
}
REFERENCES = [("loan_applications", "customer_id", "customers"), ("repayments", "loan_id", "disbursements"),
              ("disbursements", "app_id", "loan_applications"), ("collection_calls", "loan_id", "disbursements")]
MAX_ORPHAN_PERCENT = 1
LATE_DPD, HIGH_PRINCIPAL = 30, 200_000
PREFERRED, REVIEW, DECLINE = "Preferred approval", "Manual review", "Auto-decline"
GOOD_SCORE, FAIR_SCORE, POOR_SCORE = 700, 620, 580
MANY_ENQUIRIES, MANY_LOANS, LOW_UTILIZATION, MAX_EMI_SHARE = 4, 4, 0.3, 0.5
STABLE_INCOME = "Salaried"
BUCKETS = ["0 Current", "1-30 Early", "31-60 Moderate", "61-90 Severe", "90+ Critical"]


def contract_check(t: Tables, contracts: Mapping[str, Mapping] = CONTRACTS) -> DataFrame:
    """``table_name, requirement, name, violations``: missing columns, rows beyond the first of a key, orphans.

    One scan per table for its columns and key, and an anti join per foreign key.
    """
    parts = []
    for table, contract in contracts.items():
        df, key = t[table], contract["primary_key"]
        columns = [("column", c, "0L" if c in df.columns else "1L") for c in contract["columns"]]
        extra = "COUNT(*) - COUNT(DISTINCT {0})".format(key) if key in df.columns else "COUNT(*)"
        cells = ", ".join(f"'{kind}', '{name}', {n}" for kind, name, n in [*columns, ("primary_key", key, "extra")])
        parts.append(
            df.agg(F.expr(extra).alias("extra")).selectExpr(
                f"'{table}' AS table_name", f"STACK({len(columns) + 1}, {cells}) AS (requirement, name, violations)"
            )
        )
        for column, parent in contract["foreign_keys"].items():
            orphans = orphan_count(df, t[parent], column)
            parts.append(orphans.selectExpr(f"'{table}'", "'foreign_key'", f"'{column}'", "orphans"))
    return reduce(DataFrame.unionByName, [part.toDF("table_name", "requirement", "name", "violations") for part in parts])


def schema_drift(t: Tables, declared: Mapping[str, Sequence[tuple[str, str]]] | None = None) -> DataFrame:
    """``table_name, column_name, expected, found, drift, filled``: declared columns against those there.

    ``drift`` is none, type, missing or unexpected; ``filled`` counts the rows with a value.
    """
    declared = declared or {table: columns_of(table) for table in t}
    parts = []
    for table, expected in declared.items():
        wanted, there = dict(expected), dict(t[table].dtypes)
        rows = []
        for i, name in enumerate([*wanted, *(c for c in there if c not in wanted)]):
            drift = (
                "missing" if name not in there else "unexpected" if name not in wanted else "none" if wanted[name] == there[name] else "type"
            )
            rows.append((name, wanted.get(name), there.get(name), drift, f"n{i}", name in there))
        counts = [F.count(F.col(f"`{r[0]}`") if r[5] else F.lit(None)).alias(r[4]) for r in rows]
        text = lambda value: "CAST(NULL AS STRING)" if value is None else f"'{value}'"
        cells = ", ".join(f"{', '.join(map(text, r[:4]))}, {r[4]}" for r in rows)
        parts.append(
            t[table]
            .agg(*counts)
            .selectExpr(f"'{table}' AS table_name", f"STACK({len(rows)}, {cells}) AS (column_name, expected, found, drift, filled)")
        )
    return reduce(DataFrame.unionByName, parts)


def freshness(t: Tables, as_of: Column, most_days: int = 31) -> DataFrame:
    """``table_name, newest, days_old, status`` per dated table; an empty one fails."""
    parts = [
        t[table].agg(F.max(column).alias("newest")).select(F.lit(table).alias("table_name"), "newest") for table, column in DATED.items()
    ]
    days = F.datediff(as_of, F.col("newest"))
    fresh = F.coalesce(F.col("days_old") <= most_days, F.lit(False))
    return (
        reduce(DataFrame.unionByName, parts)
        .withColumn("days_old", days)
        .withColumn("status", F.when(fresh, "PASS").otherwise("FAIL"))
    )


def orphan_rates(t: Tables, references: Sequence[tuple[str, str, str]] = REFERENCES) -> DataFrame:
    """``table_name, key, row_count, orphans, orphan_pct, status``: a reference fails above one percent."""
    parts = []
    for child, key, parent in references:
        per_key = t[child].groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        known = t[parent].select(F.col(key).alias("known")).distinct()
        met = per_key.join(known, per_key[key] == known["known"], "left")
        parts.append(
            met.agg(
                F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
                F.coalesce(F.sum(F.when(F.col("known").isNull(), F.col("n"))), F.lit(0)).alias("orphans"),
            ).select(F.lit(child).alias("table_name"), F.lit(key).alias("key"), "row_count", "orphans")
        )
    return (
        reduce(DataFrame.unionByName, parts)
        .withColumn("share", F.lit(100.0) * F.col("orphans") / F.greatest("row_count", F.lit(1)))
        .withColumn("orphan_pct", round_half_even_exact("share", 3))
        .withColumn("status", F.when(F.col("share") > MAX_ORPHAN_PERCENT, "FAIL").otherwise("PASS"))
        .drop("share")
    )


def roll_matrix(repayments: DataFrame) -> DataFrame:
    """How instalments move between DPD buckets from one month on book to the next of the same loan.

    Repayments without a loan id have no previous one and are left out. A loan with very many
    instalments is shared by several tasks.
    """
    names = F.array(*map(F.lit, BUCKETS))
    placed = repayments.withColumn("state", F.array_position(names, dpd_bucket(F.col("dpd"))).cast("int"))
    moved = steps(placed, "loan_id", "state", ["mob", "due_date", "dpd"])
    step = F.col("went") - F.col("came")
    return moved.select(
        F.get(names, F.col("came") - 1).alias("from_bucket"),
        F.get(names, F.col("went") - 1).alias("to_bucket"),
        F.col("n").alias("instalments"),
        F.when(step > 0, "forward").when(step < 0, "back").otherwise("same").alias("movement"),
    )


def collection_priority(t: Tables, promises: Sequence[str] = ("Promise to pay",), high_principal: float = HIGH_PRINCIPAL) -> DataFrame:
    """Every loan with an instalment 30 or more days late, the most urgent first.

    A point each for a high outstanding principal, for more than one late instalment, and for a
    promise to pay that did not prevent it. Repayments and calls collapse to one row per loan
    before they are joined.
    """
    late = F.col("dpd") >= LATE_DPD
    per_loan = (
        t["repayments"]
        .groupBy("loan_id")
        .agg(
            F.max("dpd").alias("worst_dpd"),
            F.sum(F.when(late, 1).otherwise(0)).alias("late_instalments"),
            sum_money(F.coalesce("paid_amount", F.lit(0.0))).alias("paid"),
        )
        .filter("late_instalments > 0")
    )
    promised = (
        t["collection_calls"].filter(F.col("outcome").isin(*promises)).groupBy("loan_id").agg(F.count(F.lit(1)).alias("failed_promises"))
    )
    points = (
        F.coalesce((F.col("outstanding") >= high_principal).cast("int"), F.lit(0))
        + (F.col("late_instalments") > 1).cast("int")
        + (F.col("failed_promises") > 0).cast("int")
    )
    return (
        t["disbursements"]
        .select("loan_id", "principal")
        .join(per_loan, "loan_id")
        .join(promised, "loan_id", "left")
        .withColumn("failed_promises", F.coalesce("failed_promises", F.lit(0)))
        .withColumn("outstanding", round_half_up(F.greatest(F.col("principal") - F.col("paid"), F.lit(0.0)), 2))
        .withColumn("points", points)
        .select("loan_id", "points", "outstanding", "worst_dpd", "late_instalments", "failed_promises")
        .orderBy(F.desc("points"), F.desc_nulls_last("outstanding"), F.desc("worst_dpd"), "loan_id")
    )


def policy_decisions(t: Tables) -> DataFrame:
    """``app_id, decision`` per application: the policy's first band that applies.

    Declined: a poor score, more than one delinquency, or an instalment above half of the income.
    Reviewed: a fair score, many enquiries or loans. Preferred: a good score, stable income, low
    utilization, no delinquency. Whatever meets no band, for missing values too, is reviewed.
    """
    people = t["customers"].select("customer_id", "employment_type", "monthly_income").join(t["bureau_features"], "customer_id", "left")
    instalment = F.col("requested_amount") / F.col("tenure_months")
    weak = instalment > F.col("monthly_income") * MAX_EMI_SHARE
    score = F.col("bureau_score")
    decision = (
        F.when((score < POOR_SCORE) | (F.col("delinq_12m") > 1) | weak, DECLINE)
        .when(score.between(FAIR_SCORE, GOOD_SCORE) | (F.col("enquiries_3m") > MANY_ENQUIRIES) | (F.col("active_loans") > MANY_LOANS), REVIEW)
        .when(
            (score > GOOD_SCORE)
            & (F.col("employment_type") == STABLE_INCOME)
            & (F.col("credit_utilization") < LOW_UTILIZATION)
            & (F.col("delinq_12m") == 0),
            PREFERRED,
        )
        .otherwise(REVIEW)
    )
    applications = t["loan_applications"].select("app_id", "customer_id", "requested_amount", F.nullif("tenure_months", F.lit(0)).alias("tenure_months"))
    return applications.join(people, "customer_id", "left").select("app_id", decision.alias("decision"))


def approval_rates(t: Tables) -> DataFrame:
    """Approval rate along each monitored dimension and overall; the grouping id tells which."""
    dimensions = ["channel", "employment_type", "risk_band", "product"]
    applications = t["loan_applications"].select(
        "customer_id", "channel", "product", risk_band(F.col("risk_score")).alias("risk_band"), is_approved(F.col("approval_status")).alias("approved")
    )
    joined = applications.join(t["customers"].select("customer_id", "employment_type"), "customer_id", "left")
    sets = [[F.col(d)] for d in dimensions] + [[]]
    return joined.groupingSets(sets, *dimensions).agg(
        F.grouping_id().cast("int").alias("grouping_id"),
        F.count(F.lit(1)).alias("applications"),
        F.sum("approved").alias("approved"),
        round_half_up(percent(F.sum("approved"), F.count(F.lit(1))), 2).alias("approval_rate_pct"),
    )


# Fixed wording of an incident, by the kind of rule that failed.
CAUSES = [
    ("null_rate_", "A source stopped filling the column", "Rules and scores on the column skip rows", "Data owner: refill the column and rerun the marts"),
    ("duplicate_", "A load ran twice or a key is reused", "Counts and amounts are too high", "Data owner: deduplicate the load"),
    ("fk_", "A parent table is late or incomplete", "Rows drop out of joined marts", "Data owner: reload the parent table"),
    ("principal_", "A unit or entry error", "Exposure is misstated", "Lending operations: correct the loans"),
    ("approval_", "A policy or sourcing change", "Approvals moved beyond the limit", "Risk owner: review the last policy change"),
]


def incidents(checks: DataFrame) -> DataFrame:
    """A record for each failed rule: table, rule, severity, suspected cause, impact, action."""

    def wording(place: int) -> Column:
        chosen = F.lit("Unknown")
        for row in reversed(CAUSES):
            chosen = F.when(F.col("rule_name").startswith(row[0]), row[place]).otherwise(chosen)
        return chosen

    return checks.filter("status = 'FAIL'").select(
        "table_name",
        "rule_name",
        "severity",
        wording(1).alias("suspected_cause"),
        wording(2).alias("business_impact"),
        wording(3).alias("owner_action"),
    )
