import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from lending import portfolio
from loanlens.functions.phrases import DEMO_QUESTIONS
from loanlens.operators import retrieval
from loanlens.plans import analysis, marts, quality, questions
from loanlens.session import stored

POLICY = "retrieve_policy_context"


@pytest.fixture(scope="module")
def world(spark):
    t = portfolio(spark)
    gold = marts.gold(t)
    names = ["gold_approval_funnel", "gold_portfolio_summary", "gold_dpd_bucket_analysis"]
    return {name: stored(gold[name], name) for name in names}, stored(quality.report(t), "report")


def asked(spark, texts):
    return questions.distinct_questions(spark.createDataFrame([(q,) for q in texts], "question string"))


def hits(spark, asked_questions):
    docs = spark.createDataFrame([("p.md", "approval policy"), ("r.md", "data quality")], "source string, text string")
    return stored(retrieval.retrieve(asked_questions, retrieval.tfidf_index(docs)), "hits")


@pytest.mark.parametrize(
    ("question", "tools", "kind"),
    [
        (DEMO_QUESTIONS[0], ["approval_drop_analysis", POLICY], "approval"),
        (DEMO_QUESTIONS[1], ["delinquency_analysis", POLICY], "delinquency"),
        (DEMO_QUESTIONS[2], ["data_quality_diagnostics", "delinquency_analysis", POLICY], "quality"),
        (DEMO_QUESTIONS[3], ["portfolio_summary", POLICY], "portfolio"),
        (DEMO_QUESTIONS[4], ["approval_drop_analysis", "data_quality_diagnostics", "portfolio_summary", POLICY], "incident"),
        ("ANOMALY?", ["approval_drop_analysis", "data_quality_diagnostics", POLICY], "incident"),
        ("an incident", ["data_quality_diagnostics", POLICY], "incident"),
        ("hello", ["portfolio_summary", POLICY], "portfolio"),
        ("30 plus", ["portfolio_summary", POLICY], "portfolio"),
    ],
)
def test_routing(spark, question, tools, kind):
    row = questions.route(spark.createDataFrame([(question,)], "question string")).first()
    assert row["tools_used"] == tools and row["answer_kind"] == kind


def test_answers(spark, world):
    gold, checks = world
    q = asked(spark, [*DEMO_QUESTIONS, DEMO_QUESTIONS[0], "an incident"])
    got = {r["question"]: r for r in questions.answers(q, gold, checks, hits(spark, q)).collect()}
    assert len(got) == 6 and got[DEMO_QUESTIONS[0]]["asked"] == 2
    approval = got[DEMO_QUESTIONS[0]]["answer"]
    assert "**App / Salaried**, where approval rate moved from **100.0%** to **50.0%** in **2026-06-01**" in approval
    assert "across **2.0 latest applications**" in approval
    assert approval.endswith("\n\nPolicy sources: p.md#chunk-1, r.md#chunk-1")
    failed = quality.listing(checks).collect()
    answer = got[DEMO_QUESTIONS[2]]["answer"]
    assert f"found **{len(failed)} failed checks**" in answer
    assert f"**{failed[0]['table_name']}.{failed[0]['rule_name']}** with severity **CRITICAL**" in answer
    assert "**Impacted area:** App / Salaried." in got[DEMO_QUESTIONS[4]]["answer"]
    assert "**Impacted area:** Approval funnel / Applicant mix." in got["an incident"]["answer"]
    assert "changed from **NA%** to **NA%**" in got["an incident"]["answer"]
    assert f"covers **{sum(r['loans'] for r in gold['gold_portfolio_summary'].collect())} loans**" in got[DEMO_QUESTIONS[3]]["answer"]
    metrics = {r["question"]: r for r in questions.answer_metrics(spark.createDataFrame(list(got.values()))).collect()}
    assert metrics[DEMO_QUESTIONS[0]]["answer_chars"] == len(approval)
    assert {(r["has_policy_citation"], r["mentions_action"]) for r in metrics.values()} == {(1, 1)}


def test_findings_without_rows_fall_back(spark, world):
    gold, checks = world
    empty = {name: df.filter("false") for name, df in gold.items()}
    got = {r["kind"]: r for r in questions.findings(empty, checks.filter("status = 'nothing'")).collect()}
    assert len(got) == 6
    assert got["approval"]["finding"].startswith("No approval-rate drop") and not got["approval"]["cites_policy"]
    assert got["portfolio"]["finding"].startswith("No portfolio-summary rows")
    assert "No critical DQ rule returned / NA" in got["incident"]["finding"]


def test_the_portfolio_finding_covers_more_segments_than_are_displayed(spark):
    kinds = "disbursed_month date, product string, channel string, risk_band string, loans long, principal_disbursed double, avg_risk_score double, avg_bureau_score double"
    data = [(date(2026, 1 + i % 3, 1), f"p{i}", "App", "Low", 2, 1000.0 * i, 300.0, 600.0) for i in range(1, 16)]
    found = questions.portfolio_finding(spark.createDataFrame(data, kinds)).first()["finding"]
    assert "covers **30 loans**" in found and "about **₹120000.0** disbursed" in found
    assert "**p15 / App / Low**" in found


def test_evidence_rows_and_json_agree(spark, world):
    gold, checks = world
    q = asked(spark, DEMO_QUESTIONS)
    docs = spark.createDataFrame([("p.md", 1, "approval policy"), ("r.md", 1, "data quality")], "source string, chunk_no int, text string")
    passages = hits(spark, q).join(docs, ["source", "chunk_no"])
    cells = {(r["question"], r["tool"], r["row_number"], r["column_name"]): r["value"] for r in questions.evidence_rows(q, gold, checks, passages).collect()}
    n = 0
    for row in questions.evidence(q, gold, checks, passages).collect():
        for tool, shown in json.loads(row["evidence"]).items():
            for number, values in enumerate(shown, 1):
                for name, value in values.items():
                    told = cells[row["question"], tool, number, name]
                    assert told == value if isinstance(value, str | None) else float(told) == pytest.approx(value, abs=1e-4)
                    n += 1
    assert n == len(cells)


def test_evidence_holds_the_rows_of_the_tools(spark, world):
    gold, checks = world
    q = asked(spark, DEMO_QUESTIONS)
    found = hits(spark, q)
    docs = spark.createDataFrame([("p.md", 1, "approval policy"), ("r.md", 1, "data quality")], "source string, chunk_no int, text string")
    rows = questions.evidence(q, gold, checks, found.join(docs, ["source", "chunk_no"])).collect()
    for row in rows:
        evidence = json.loads(row["evidence"])
        assert list(evidence) == [*row["tools_used"][:-1], "policy_context"]
        assert len(evidence["policy_context"]) == 2 and set(evidence["policy_context"][0]) == {"source", "text", "score"}
    incident = json.loads(next(r for r in rows if r["question"] == DEMO_QUESTIONS[4])["evidence"])
    drops = [r.asDict() for r in analysis.approval_drop(gold["gold_approval_funnel"]).collect()]
    assert [d["approval_drop_pp"] for d in incident["approval_drop_analysis"]] == [d["approval_drop_pp"] for d in drops]
    listed = [(r["table_name"], r["rule_name"]) for r in quality.listing(checks).collect()]
    assert [(d["table_name"], d["rule_name"]) for d in incident["data_quality_diagnostics"]] == listed
    assert [d["loans"] for d in incident["portfolio_summary"]] == [
        r["loans"] for r in analysis.portfolio_top(gold["gold_portfolio_summary"]).select(F.col("loans")).collect()
    ]
