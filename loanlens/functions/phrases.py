"""Routing words, tool names and the wording of the written findings."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F

APPROVAL_WORDS = ["approval", "approve", "drop", "funnel", "rejected"]
QUALITY_WORDS = ["quality", "dq", "null", "duplicate", "schema", "failure"]
DELINQUENCY_WORDS = ["dpd", "delinquency", "default", "overdue", "repayment", "30+"]
PORTFOLIO_WORDS = ["portfolio", "summary", "overall", "risk", "health", "citation"]

APPROVAL_TOOL = "approval_drop_analysis"
QUALITY_TOOL = "data_quality_diagnostics"
DELINQUENCY_TOOL = "delinquency_analysis"
PORTFOLIO_TOOL = "portfolio_summary"
POLICY_TOOL = "retrieve_policy_context"
POLICY_EVIDENCE = "policy_context"

APPROVAL_TEXT = (
    "**Direct finding:** The largest approval-rate decline is in **{channel} / {employment_type}**, "
    "where approval rate moved from **{previous_approval_rate_pct}%** to **{latest_approval_rate_pct}%** "
    "in **{latest_month}**, a drop of **{approval_drop_pp} percentage points**.\n\n"
    "**Evidence:** The same segment's average risk score increased from **{previous_avg_risk_score}** to "
    "**{latest_avg_risk_score}** across **{latest_applications} latest applications**, which suggests a mix-shift "
    "toward riskier applicants rather than only a reporting issue.\n\n"
    "**Recommended action:** Compare Partner/Branch sourcing mix, bureau-score distribution, employment-type mix, "
    "and cutoff changes month over month. Validate the approval mart before making a policy decision.\n\n"
)
APPROVAL_NONE = (
    "No approval-rate drop was found in the latest available synthetic portfolio window. Recommended action: "
    "verify the latest application month and rerun the approval funnel mart."
)
DELINQUENCY_TEXT = (
    "**Direct finding:** The highest 30+ DPD hotspot is **{product} / {channel} / {risk_band}** "
    "for due month **{due_month}**.\n\n"
    "**Evidence:** This segment shows **{avg_30_plus_dpd_rate_pct}% average 30+ DPD rate** and "
    "**₹{amount_30_plus_due}** amount due in 30+ DPD buckets across **{instalments} instalments**.\n\n"
    "**Recommended action:** Prioritize collections for 30+ DPD accounts, review repeat delinquency, and check "
    "whether this is a small-count spike or a broad segment deterioration.\n\n"
)
DELINQUENCY_NONE = (
    "No delinquency rows were returned from the DPD mart. Recommended action: check repayment enrichment and DPD "
    "bucket logic."
)
QUALITY_TEXT = (
    "**Direct finding:** The data-quality layer found **{failed} failed checks**. The highest-priority issue is "
    "**{table_name}.{rule_name}** with severity **{severity}**.\n\n"
    "**Evidence:** Metric value is **{metric_value}**. Details: {details}.\n\n"
    "**Recommended action:** Assign an owner, validate upstream ingestion for the impacted table, rerun the failed "
    "rule after fixing the source/mart, and block risk reporting if the failed rule affects approval, repayment, or "
    "bureau fields.\n\n"
)
QUALITY_NONE = (
    "No failed data-quality checks were found. Recommended action: still review freshness and schema drift before "
    "using the marts for decisioning."
)
PORTFOLIO_TEXT = (
    "**Direct finding:** The latest portfolio view covers **{total_loans} loans** in the displayed gold mart slice, "
    "with about **₹{total_principal}** disbursed principal.\n\n"
    "**Evidence:** The largest displayed segment is **{product} / {channel} / {risk_band}**, "
    "with **₹{principal_disbursed}** principal and average risk score **{avg_risk_score}**.\n\n"
    "**Recommended action:** Review portfolio concentration by product, channel, and risk band; combine this with "
    "approval-drop and DPD hotspot analysis before making credit-policy changes.\n\n"
)
PORTFOLIO_NONE = "No portfolio-summary rows were returned. Recommended action: rebuild the gold portfolio mart."
INCIDENT_TEXT = (
    "**Incident summary:** Approval anomaly detected in the latest synthetic portfolio window.\n\n"
    "**Impacted area:** {channel} / {employment_type}.\n\n"
    "**Observed movement:** Approval rate changed from **{previous_approval_rate_pct}%** to "
    "**{latest_approval_rate_pct}%**, a **{approval_drop_pp} pp** decline. Average risk score moved from "
    "**{previous_avg_risk_score}** to **{latest_avg_risk_score}**.\n\n"
    "**DQ cross-check:** {table_name} / {rule_name} is the top failed rule to validate before final RCA.\n\n"
    "**Recommended owner action:** Risk analytics should validate applicant mix and cutoff changes; data engineering "
    "should validate freshness, schema, and primary/foreign-key checks; business should review sourcing-channel "
    "quality.\n\n"
)
INCIDENT_DEFAULTS = {
    "channel": "Approval funnel",
    "employment_type": "Applicant mix",
    "table_name": "No critical DQ rule returned",
    "rule_name": "NA",
}
NO_POLICY = "No policy source retrieved"
POLICY_LINE = "**Policy context:** "
SOURCES_LINE = "\n\nPolicy sources: "
MISSING = "NA"
MISSING_NUMBER = "nan"
MISSING_DATE = "NaT"

DEMO_QUESTIONS = [
    "Why did approval rate drop this month?",
    "Which segment has the highest 30+ DPD?",
    "Show data quality issues in repayment data.",
    "Summarize portfolio risk with policy citations.",
    "Generate an incident summary for the approval anomaly.",
]


def render(template: str, values: dict[str, Column]) -> Column:
    """The template with each ``{name}`` replaced by the text column of that name."""
    parts = []
    for literal, name, _, _ in Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if name:
            parts.append(values[name])
    return F.concat(*parts)
