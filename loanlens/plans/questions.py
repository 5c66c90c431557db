"""From questions to written findings, as a batch job over question rows.

Many rows ask the same thing, so the rows are first reduced to distinct
questions with a count. A finding depends on the marts only and is computed
once per kind of answer.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.functions import phrases as p
from loanlens.functions.numbers import float_text, sum_money
from loanlens.operators import retrieval
from loanlens.plans import analysis, quality

Tables = Mapping[str, DataFrame]
KINDS = ["incident", "quality", "delinquency", "approval", "portfolio"]


def _mentions(text: Column, words: list[str]) -> Column:
    return reduce(Column.__or__, [text.contains(word) for word in words])


def flags(questions: DataFrame) -> DataFrame:
    """Topics a question touches, by substring of its lower-case text."""
    text = F.lower("question")
    return (
        questions.withColumn("asks_approval", _mentions(text, [*p.APPROVAL_WORDS, "anomaly"]))
        .withColumn("asks_quality", _mentions(text, [*p.QUALITY_WORDS, "incident", "anomaly"]))
        .withColumn("asks_delinquency", _mentions(text, p.DELINQUENCY_WORDS))
        .withColumn("asks_portfolio", _mentions(text, p.PORTFOLIO_WORDS))
    )


def tools(flagged: DataFrame) -> DataFrame:
    """The analyses to run, in order; the portfolio also when no other topic matched, the policies always."""
    no_other = ~(F.col("asks_approval") | F.col("asks_quality") | F.col("asks_delinquency"))
    return flagged.withColumn(
        "tools_used",
        F.array_compact(
            F.array(
                F.when(F.col("asks_approval"), p.APPROVAL_TOOL),
                F.when(F.col("asks_quality"), p.QUALITY_TOOL),
                F.when(F.col("asks_delinquency"), p.DELINQUENCY_TOOL),
                F.when(F.col("asks_portfolio") | no_other, p.PORTFOLIO_TOOL),
                F.lit(p.POLICY_TOOL),
            )
        ),
    )


def answer_kind(questions: DataFrame) -> DataFrame:
    """The one template that answers; its precedence differs from the order of the tools."""
    text = F.lower("question")
    return questions.withColumn(
        "answer_kind",
        F.when(_mentions(text, ["incident", "anomaly"]), "incident")
        .when(_mentions(text, p.QUALITY_WORDS), "quality")
        .when(_mentions(text, p.DELINQUENCY_WORDS), "delinquency")
        .when(_mentions(text, p.APPROVAL_WORDS), "approval")
        .otherwise("portfolio"),
    )


def route(questions: DataFrame) -> DataFrame:
    return answer_kind(tools(flags(questions)))


def distinct_questions(questions: DataFrame) -> DataFrame:
    """``question_id, question, asked``; counts are added up per task before the shuffle."""
    return questions.groupBy("question").agg(F.count(F.lit(1)).alias("asked")).withColumn("question_id", F.col("question"))


def _name(value: Column) -> Column:
    return F.coalesce(value, F.lit(p.MISSING))


def _number(value: Column, digits: int = 2) -> Column:
    return F.coalesce(float_text(value, digits), F.lit(p.MISSING_NUMBER))


def _date(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(p.MISSING_DATE))


def _first_row(rows: DataFrame) -> DataFrame:
    """One row ``top``: the first of a short ordered result as a struct, NULL if there is none."""
    return rows.limit(1).agg(F.first(F.struct("*")).alias("top"))


def _approval_values(top: Column) -> dict[str, Column]:
    return {
        "channel": _name(top["channel"]),
        "employment_type": _name(top["employment_type"]),
        "latest_month": _date(top["latest_month"]),
        "latest_applications": _number(top["latest_applications"]),
        **{
            name: _number(top[name])
            for name in (
                "previous_approval_rate_pct",
                "latest_approval_rate_pct",
                "approval_drop_pp",
                "previous_avg_risk_score",
                "latest_avg_risk_score",
            )
        },
    }


def _finding(kind: str, rows: DataFrame, found: Column, text: Column, none: str) -> DataFrame:
    """``kind, finding, cites_policy``: the text if there was something to report, else the fallback."""
    return rows.select(
        F.lit(kind).alias("kind"),
        F.when(found, text).otherwise(none).alias("finding"),
        found.alias("cites_policy"),
    )


def approval_finding(funnel: DataFrame) -> DataFrame:
    top = F.col("top")
    return _finding(
        "approval",
        _first_row(analysis.approval_drop(funnel)),
        top.isNotNull(),
        p.render(p.APPROVAL_TEXT, _approval_values(top)),
        p.APPROVAL_NONE,
    )


def delinquency_finding(buckets: DataFrame) -> DataFrame:
    top = F.col("top")
    values = {
        "product": _name(top["product"]),
        "channel": _name(top["channel"]),
        "risk_band": _name(top["risk_band"]),
        "due_month": _date(top["due_month"]),
        "avg_30_plus_dpd_rate_pct": _number(top["avg_30_plus_dpd_rate_pct"]),
        "amount_30_plus_due": _number(top["amount_30_plus_due"]),
        "instalments": _number(top["instalments"]),
    }
    return _finding(
        "delinquency",
        _first_row(analysis.delinquency(buckets)),
        top.isNotNull(),
        p.render(p.DELINQUENCY_TEXT, values),
        p.DELINQUENCY_NONE,
    )


def _worst_failure(checks: DataFrame) -> DataFrame:
    """One row: how many checks failed, and the first of them in the order of the listing."""
    order = F.struct(quality.severity_rank(F.col("severity")).alias("severity_rank"), "table_name", "rule_name")
    return checks.filter("status = 'FAIL'").agg(
        F.count(F.lit(1)).alias("failed"), F.min_by(F.struct("*"), order).alias("top")
    )


def quality_finding(checks: DataFrame) -> DataFrame:
    top = F.col("top")
    values = {
        "failed": F.col("failed").cast("string"),
        "table_name": _name(top["table_name"]),
        "rule_name": _name(top["rule_name"]),
        "severity": _name(top["severity"]),
        "metric_value": _number(top["metric_value"], 3),
        "details": _name(top["details"]),
    }
    return _finding(
        "quality", _worst_failure(checks), F.col("failed") > 0, p.render(p.QUALITY_TEXT, values), p.QUALITY_NONE
    )


def portfolio_finding(summary: DataFrame) -> DataFrame:
    """Totals over the whole portfolio, and its largest segment."""
    largest = F.struct(
        F.coalesce("principal_disbursed", F.lit(0.0)).alias("amount"),
        "disbursed_month",
        "product",
        "channel",
        "risk_band",
        "principal_disbursed",
        "avg_risk_score",
    )
    totals = summary.agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("loans").alias("loans"),
        sum_money(F.col("principal_disbursed")).alias("principal"),
        F.max(largest).alias("top"),
    )
    top = F.col("top")
    values = {
        "total_loans": F.coalesce("loans", F.lit(0)).cast("string"),
        "total_principal": float_text(F.coalesce("principal", F.lit(0.0)), 2),
        "product": _name(top["product"]),
        "channel": _name(top["channel"]),
        "risk_band": _name(top["risk_band"]),
        "principal_disbursed": _number(top["principal_disbursed"]),
        "avg_risk_score": _number(top["avg_risk_score"]),
    }
    return _finding("portfolio", totals, F.col("rows") > 0, p.render(p.PORTFOLIO_TEXT, values), p.PORTFOLIO_NONE)


def incident_finding(funnel: DataFrame, checks: DataFrame, with_approval: bool = True) -> DataFrame:
    """The largest approval drop next to the worst failed check.

    A question that says "incident" without an approval word has no approval
    rows to draw on; ``with_approval=False`` is the text for that case.
    """
    none = {name: F.lit(p.INCIDENT_DEFAULTS.get(name, p.MISSING)) for name in _approval_values(F.col("top"))}
    rows = _worst_failure(checks).withColumnRenamed("top", "check")
    if with_approval:
        approval = F.col("approval")
        rows = rows.withColumn("approval", _first_row(analysis.approval_drop(funnel)).scalar())
        values = {
            name: F.when(approval.isNull(), none[name]).otherwise(value)
            for name, value in _approval_values(approval).items()
        }
    else:
        values = none
    check = F.col("check")
    for name in ("table_name", "rule_name"):
        values[name] = F.when(check.isNull(), p.INCIDENT_DEFAULTS[name]).otherwise(_name(check[name]))
    kind = "incident" if with_approval else "incident without approval rows"
    return _finding(kind, rows, F.lit(True), p.render(p.INCIDENT_TEXT, values), "")


def findings(marts: Tables, checks: DataFrame) -> DataFrame:
    """Six rows, one per kind of answer."""
    funnel = marts["gold_approval_funnel"]
    parts = [
        approval_finding(funnel),
        delinquency_finding(marts["gold_dpd_bucket_analysis"]),
        quality_finding(checks),
        portfolio_finding(marts["gold_portfolio_summary"]),
        incident_finding(funnel, checks),
        incident_finding(funnel, checks, with_approval=False),
    ]
    return reduce(DataFrame.unionByName, parts)


def answers(questions: DataFrame, marts: Tables, checks: DataFrame, hits: DataFrame) -> DataFrame:
    """One row per distinct question: ``question, asked, answer_kind, tools_used, citations, answer``.

    ``questions`` comes from ``distinct_questions``; ``hits`` from ``retrieve`` on the same rows.
    """
    lacks_approval = (F.col("answer_kind") == "incident") & ~F.col("asks_approval")
    kind = F.when(lacks_approval, "incident without approval rows").otherwise(F.col("answer_kind"))
    asked = (
        route(questions)
        .withColumn("kind", kind)
        .join(retrieval.citations(hits), "question_id", "left")
        .withColumn("citations", F.coalesce("citations", F.array().cast("array<string>")))
    )
    sources = F.array_distinct("citations")
    policy = F.when(F.size(sources) > 0, F.array_join(sources, ", ")).otherwise(p.NO_POLICY)
    body = F.when(F.col("cites_policy"), F.concat("finding", F.lit(p.POLICY_LINE), policy)).otherwise(F.col("finding"))
    source_line = F.when(
        F.size("citations") > 0, F.concat(F.lit(p.SOURCES_LINE), F.array_join("citations", ", "))
    ).otherwise("")
    return asked.join(F.broadcast(findings(marts, checks)), "kind").select(
        "question", "asked", "answer_kind", "tools_used", "citations", F.concat(body, source_line).alias("answer")
    )


def answer_metrics(answered: DataFrame) -> DataFrame:
    text = F.lower("answer")
    return answered.select(
        "question",
        "asked",
        F.length("answer").alias("answer_chars"),
        (F.size("citations") > 0).cast("int").alias("has_policy_citation"),
        (text.contains("action") | text.contains("recommended")).cast("int").alias("mentions_action"),
    )


def _rows_as_json(rows: DataFrame) -> Column:
    """A short ordered result as a JSON array, in its order."""
    numbered = rows.withColumn("n", F.monotonically_increasing_id())
    ordered = numbered.agg(F.sort_array(F.collect_list(F.struct("n", F.struct(*rows.columns).alias("row")))).alias("r"))
    return ordered.select(F.to_json(F.transform("r", lambda x: x["row"]), {"ignoreNullFields": "false"})).scalar()


def evidence(questions: DataFrame, marts: Tables, checks: DataFrame, passages: DataFrame) -> DataFrame:
    """Per distinct question the rows its tools returned, as one JSON object.

    ``passages`` are hits with their text. Every result shown is short: ten to
    twelve rows, the failed checks, and a few passages per question.
    """
    results = {
        p.APPROVAL_TOOL: analysis.approval_drop(marts["gold_approval_funnel"]),
        p.QUALITY_TOOL: quality.listing(checks),
        p.DELINQUENCY_TOOL: analysis.delinquency(marts["gold_dpd_bucket_analysis"]),
        p.PORTFOLIO_TOOL: analysis.portfolio_top(marts["gold_portfolio_summary"]),
    }
    shown = F.struct(retrieval.chunk_id().alias("source"), "text", "score")
    context = passages.groupBy("question_id").agg(
        F.sort_array(F.collect_list(F.struct("rank", shown.alias("hit")))).alias("hits")
    )
    policy = F.coalesce(F.to_json(F.transform("hits", lambda x: x["hit"])), F.lit("[]"))
    entries = [
        F.when(F.array_contains("tools_used", tool), F.concat(F.lit(f'"{tool}":'), _rows_as_json(rows)))
        for tool, rows in results.items()
    ]
    entries.append(F.concat(F.lit(f'"{p.POLICY_EVIDENCE}":'), policy))
    return (
        tools(flags(questions))
        .join(context, "question_id", "left")
        .select(
            "question",
            "tools_used",
            F.concat(F.lit("{"), F.array_join(F.array_compact(F.array(*entries)), ","), F.lit("}")).alias("evidence"),
        )
    )


def evidence_rows(questions: DataFrame, marts: Tables, checks: DataFrame, passages: DataFrame) -> DataFrame:
    """The same evidence as rows: ``question, tool, row_number, column_name, value``, numbers with four decimals."""
    results = {
        p.APPROVAL_TOOL: analysis.approval_drop(marts["gold_approval_funnel"]),
        p.QUALITY_TOOL: quality.listing(checks),
        p.DELINQUENCY_TOOL: analysis.delinquency(marts["gold_dpd_bucket_analysis"]),
        p.PORTFOLIO_TOOL: analysis.portfolio_top(marts["gold_portfolio_summary"]),
    }
    shown = reduce(DataFrame.unionByName, [_cells(_numbered(rows), tool, rows) for tool, rows in results.items()])
    asked = tools(flags(questions)).select("question", F.explode("tools_used").alias("tool"))
    hits = passages.select("question_id", F.col("rank").alias("row_number"), retrieval.chunk_id().alias("source"), "text", "score")
    cited = _cells(hits, p.POLICY_EVIDENCE, hits.select("source", "text", "score"), "question_id")
    return asked.join(shown, "tool").select("question", "tool", "row_number", "column_name", "value").unionByName(
        cited.withColumnRenamed("question_id", "question")
    )


def _numbered(rows: DataFrame) -> DataFrame:
    """A short ordered result with ``row_number`` from 1, in its order."""
    placed = rows.withColumn("n", F.monotonically_increasing_id())
    ordered = placed.agg(F.sort_array(F.collect_list(F.struct("n", F.struct(*rows.columns).alias("row")))).alias("r"))
    return ordered.select(F.posexplode("r").alias("pos", "x")).select((F.col("pos") + 1).alias("row_number"), "x.row.*")


def _cells(numbered: DataFrame, tool: str, shape: DataFrame, *keys: str) -> DataFrame:
    """One row per cell of the columns of ``shape``."""

    def text(name: str, kind: str) -> Column:
        return (F.col(name).cast("decimal(30,4)") if kind == "double" else F.col(name)).cast("string")

    cells = [F.struct(F.lit(name).alias("column_name"), text(name, kind).alias("value")) for name, kind in shape.dtypes]
    return numbered.select(*keys, F.lit(tool).alias("tool"), "row_number", F.inline(F.array(*cells)))
