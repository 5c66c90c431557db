"""Registered queries: each takes a session and the folder of the Parquet tables.

The lending tables are derived from the order-entry tables found there; see
``loanlens/sources/star_schema.py``.
"""

from __future__ import annotations

import importlib
import sys
import uuid
from collections import ChainMap
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import oracle  # noqa: E402
from loanlens.functions.numbers import round_half_up, sum_money  # noqa: E402
from loanlens.lazy import Lazy  # noqa: E402
from loanlens.operators import postings, retrieval  # noqa: E402
from loanlens.plans import analysis, derive, marts, policy, profiles, quality, questions, states  # noqa: E402
from loanlens.session import shared_folder, stored  # noqa: E402
from loanlens.sources import buckets, corpus, store, tables  # noqa: E402
from loanlens.sources.star_schema import StarSchema  # noqa: E402

Query = Callable[[SparkSession, str], DataFrame]


def _tables(spark: SparkSession, folder: str) -> Lazy:
    return StarSchema(spark, folder).lending


def _gold(spark: SparkSession, folder: str) -> Lazy:
    return marts.gold(_tables(spark, folder))


def _checks(spark: SparkSession, folder: str) -> DataFrame:
    return quality.report(_tables(spark, folder))


def _index(spark: SparkSession, folder: str) -> retrieval.Index:
    """The stored index of the documents, written when a query of this application first asks for it."""
    documents = corpus.read_documents(spark, folder)
    return store.kept(spark, "index", [documents], lambda: retrieval.tfidf_index(documents))


def _chunks(spark: SparkSession, folder: str) -> DataFrame:
    return retrieval.chunks(corpus.read_documents(spark, folder))


def _hits(spark: SparkSession, folder: str) -> DataFrame:
    asked = questions.distinct_questions(StarSchema(spark, folder).questions())
    return retrieval.retrieve(asked, _index(spark, folder))


def _by_loan(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Repayments and loan features, laid out by loan: written when a query of this application first asks for them."""
    t = _tables(spark, folder)

    def make() -> tuple[DataFrame, DataFrame]:
        target, mark = f"{shared_folder(spark)}/buckets-{uuid.uuid4().hex}", uuid.uuid4().hex[:12]
        features = buckets.write_bucketed(marts.loan_features(t), target, f"loans_{mark}", "loan_id")
        repayments = StarSchema(spark, folder).repayments_by_loan(buckets.BUCKETS)
        return buckets.write_bucketed(repayments, target, f"repayments_{mark}", "loan_id", dealt=True), features

    return store.kept(spark, "buckets", [t["repayments"], t["disbursements"]], make)


def _read_often(spark: SparkSession, folder: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """The marts and the report that several findings read: written when a query of this application first asks for them.

    Joins and groups by loan need no shuffle of their own, as repayments and loans are laid out by loan.
    """
    t = _tables(spark, folder)

    def make() -> dict[str, DataFrame]:
        repayments, features = _by_loan(spark, folder)
        named = {
            "gold_approval_funnel": marts.approval_funnel(t),
            "gold_portfolio_summary": marts.portfolio_summary(features),
            "gold_dpd_bucket_analysis": marts.dpd_bucket_analysis(marts.repayment_enriched(repayments, features)),
            "gold_data_quality_report": quality.report(ChainMap({"repayments": repayments}, t)),
        }
        return store.written_together(named)

    found = dict(store.kept(spark, "read often", [t[name] for name in tables.SCHEMAS], make))
    return found, found.pop("gold_data_quality_report")


def _answers(spark: SparkSession, folder: str) -> DataFrame:
    asked = questions.distinct_questions(StarSchema(spark, folder).questions())
    return questions.answers(asked, *_read_often(spark, folder), _hits(spark, folder))


def _silver(name: str) -> Query:
    return lambda spark, folder: tables.silver(_tables(spark, folder))[name]


def _mart(name: str) -> Query:
    return lambda spark, folder: _gold(spark, folder)[name]


def _checked(rule: str) -> Query:
    return lambda spark, folder: quality.check(rule, _tables(spark, folder))


def _derived(derivation: Callable[[Lazy], DataFrame]) -> Query:
    return lambda spark, folder: derivation(_tables(spark, folder))


def _asked(name: str, analyse: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: analyse(_gold(spark, folder)[name])


def _listed(analyse: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: analyse(_checks(spark, folder))


def risk_band_distribution(features: DataFrame) -> DataFrame:
    return features.groupBy("risk_band").agg(
        F.count(F.lit(1)).alias("loans"),
        F.min("risk_score").alias("lowest_score"),
        F.max("risk_score").alias("highest_score"),
    )


def dpd_bucket_distribution(enriched: DataFrame) -> DataFrame:
    return enriched.groupBy("dpd_bucket").agg(
        F.count(F.lit(1)).alias("instalments"),
        F.min("dpd").alias("lowest_dpd"),
        F.max("dpd").alias("highest_dpd"),
        round_half_up(sum_money(F.col("due_amount")), 2).alias("amount_due"),
    )


def thirty_plus_boundary(enriched: DataFrame) -> DataFrame:
    return enriched.groupBy("dpd", "dpd_bucket", "is_30_plus_dpd").agg(F.count(F.lit(1)).alias("instalments"))


def mart_row_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Counted from written tables; those that the findings read are not written again."""
    often, checks = _read_often(spark, folder)
    read = [_tables(spark, folder)[name] for name in tables.SCHEMAS]
    return analysis.row_counts(often | store.kept(spark, "other marts", read, lambda: _others(spark, folder)), checks)


def _others(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The loan features were written by loan before, and are read back by the marts that are derived from them."""
    repayments, features = _by_loan(spark, folder)
    enriched = marts.repayment_enriched(repayments, features)
    made = {"gold_repayment_enriched": enriched, "gold_vintage_analysis": marts.vintage_analysis(enriched)}
    return {"gold_loan_features": features} | store.written_together(made)


def adhoc_sql_mart(spark: SparkSession, folder: str) -> DataFrame:
    text = """
        SELECT product, risk_band, SUM(loans) AS loans, MAX(principal_disbursed) AS largest_month
        FROM gold_portfolio_summary GROUP BY product, risk_band HAVING SUM(loans) > 0
    """
    return analysis.run_sql(spark, text, _gold(spark, folder))


def text_chunks(spark: SparkSession, folder: str) -> DataFrame:
    return _chunks(spark, folder).select(retrieval.chunk_id(), "source", "chunk_no", "text")


def chunk_tokens(spark: SparkSession, folder: str) -> DataFrame:
    from loanlens.functions.text import tokens

    found = F.array_join(tokens(F.col("text")), " ").alias("tokens")
    return _chunks(spark, folder).select("source", "chunk_no", found)


def chunk_ngrams(spark: SparkSession, folder: str) -> DataFrame:
    return retrieval.chunk_term_counts(corpus.read_documents(spark, folder)).withColumn("tf", F.col("tf").cast("long"))


def tfidf_vocabulary(spark: SparkSession, folder: str) -> DataFrame:
    return retrieval.vocabulary(corpus.read_documents(spark, folder)).withColumn("idf", F.round("idf", 6))


def tfidf_weights(spark: SparkSession, folder: str) -> DataFrame:
    return retrieval.weights(corpus.read_documents(spark, folder)).withColumn("weight", F.round("weight", 6))


def tfidf_cosine(spark: SparkSession, folder: str) -> DataFrame:
    """How many chunks each passage meets, and how closely."""
    index = _index(spark, folder)
    met = retrieval.cosine_summary(retrieval.asked_terms(StarSchema(spark, folder).passages_to_find(), index), index)
    return met.withColumn("best_score", F.round("best_score", 4)).withColumn("total_score", F.round("total_score", 3))


def policy_top_k(spark: SparkSession, folder: str) -> DataFrame:
    index = _index(spark, folder)
    hits = retrieval.retrieve(StarSchema(spark, folder).passages_to_find(), index)
    return retrieval.with_text(hits, index.chunks).select("question_id", "rank", "source", "chunk_no", "text", "score")


def citations_per_question(spark: SparkSession, folder: str) -> DataFrame:
    cited = retrieval.citations(_hits(spark, folder))
    return cited.select(F.col("question_id").alias("question"), F.array_join("citations", ", ").alias("citations"))


def question_flags(spark: SparkSession, folder: str) -> DataFrame:
    return questions.flags(StarSchema(spark, folder).questions())


def question_tools(spark: SparkSession, folder: str) -> DataFrame:
    routed = questions.tools(questions.flags(StarSchema(spark, folder).questions()))
    return routed.select("event_id", "question", F.array_join("tools_used", ",").alias("tools_used"))


def question_answer_kind(spark: SparkSession, folder: str) -> DataFrame:
    return questions.answer_kind(StarSchema(spark, folder).questions())


def report_incident(spark: SparkSession, folder: str) -> DataFrame:
    return questions.incident_finding(_gold(spark, folder)["gold_approval_funnel"], _checks(spark, folder))


def question_answers(spark: SparkSession, folder: str) -> DataFrame:
    return _answers(spark, folder).select(
        "question", "asked", "answer_kind", F.array_join("tools_used", ",").alias("tools_used"), "answer"
    )


def answer_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return questions.answer_metrics(_answers(spark, folder))


def evidence_json(spark: SparkSession, folder: str) -> DataFrame:
    asked = questions.distinct_questions(StarSchema(spark, folder).questions())
    index = _index(spark, folder)
    passages = retrieval.with_text(retrieval.retrieve(asked, index), index.chunks)
    return questions.evidence_rows(asked, *_read_often(spark, folder), passages)


def conversation_routing(spark: SparkSession, folder: str) -> DataFrame:
    """Which analyses real texts ask for."""
    routed = questions.route(StarSchema(spark, folder).conversations())
    return routed.select("conv_id", "turn", "role", "answer_kind", F.array_join("tools_used", ",").alias("tools_used"))


def dq_freshness(spark: SparkSession, folder: str) -> DataFrame:
    return policy.freshness(_tables(spark, folder), F.lit("2026-07-31").cast("date"))


def collection_priority(spark: SparkSession, folder: str) -> DataFrame:
    return policy.collection_priority(_tables(spark, folder), promises=["purchase"])


def _states(spark: SparkSession, folder: str) -> str:
    """The folder of states of two loads: the loans of the last month, and their applications, come after all repayments."""
    t = _tables(spark, folder)

    def make() -> str:
        target = f"{shared_folder(spark)}/states-{uuid.uuid4().hex}"
        last = t["disbursements"].agg(F.trunc(F.max("disbursed_date"), "month")).scalar()
        late = {"disbursements": F.col("disbursed_date") >= last, "loan_applications": F.col("application_date") >= last, "repayments": F.lit(False)}
        for second in (False, True):
            load = {name: t[name].where(F.coalesce(rows, F.lit(False)) == second) for name, rows in late.items()}
            named = {"customers": t["customers"], "bureau_features": t["bureau_features"], "known_applications": t["loan_applications"]}
            states.append(spark, named | load, target)
        return target

    return store.kept(spark, "states", [t["disbursements"], t["repayments"], t["loan_applications"]], make)


def _from_states(name: str) -> Query:
    return lambda spark, folder: states.mart(spark, _states(spark, folder), name)


def _profiles(spark: SparkSession, folder: str) -> str:
    """The folder of profiles of three loads: rows by the month of their date, so that many come before the rows they refer to."""
    t = _tables(spark, folder)
    dates = {"loan_applications": "application_date", "disbursements": "disbursed_date", "repayments": "due_date", "collection_calls": "call_date"}

    def make() -> str:
        target = f"{shared_folder(spark)}/profiles-{uuid.uuid4().hex}"
        # every load reads repayments three times; as a join of two large tables they are made once
        made = {name: stored(t[name], name) if name == "repayments" else t[name] for name in dates}
        for load in range(3):
            rows = {name: made[name].where(F.coalesce(F.month(date) % 3, F.lit(0)) == load) for name, date in dates.items()}
            first = {name: t[name] for name in ("customers", "bureau_features")} if load == 0 else {}
            profiles.append(spark, first | rows, target)
        return target

    return store.kept(spark, "profiles", [t[name] for name in ("customers", *dates)], make)


def quality_report_from_profiles(spark: SparkSession, folder: str) -> DataFrame:
    return profiles.report(spark, _profiles(spark, folder))


def profile_history(spark: SparkSession, folder: str) -> DataFrame:
    return profiles.history(spark, _profiles(spark, folder))


def distinct_loans_rollup(spark: SparkSession, folder: str) -> DataFrame:
    groupings = {"month and band": ("disbursed_month", "risk_band"), "month on book": ("mob",), "all": ()}
    return states.loans_by(spark, _states(spark, folder), groupings)


def enriched_from_buckets(spark: SparkSession, folder: str) -> DataFrame:
    """The repayments with their loans, from tables laid out by loan."""
    return marts.repayment_enriched(*_by_loan(spark, folder))


def frequent_vocabulary(spark: SparkSession, folder: str) -> DataFrame:
    """The terms that a vocabulary of 5,000 keeps."""
    documents = corpus.read_documents(spark, folder)
    rows = store.kept(spark, "segments", [documents], lambda: stored(postings.segments(corpus.spread(documents)), "segments"))
    return retrieval.frequent_terms(rows, 5000)[0]


def risk_score_formula(spark: SparkSession, folder: str) -> DataFrame:
    return derive.risk_scores(_tables(spark, folder))


def disburse_approved(spark: SparkSession, folder: str) -> DataFrame:
    lag = (F.col("app_id").cast("long") % 6 + 1).cast("int")
    return derive.disburse_approved(_tables(spark, folder)["loan_applications"], lag)


def _training_modules() -> tuple:
    """The queries and the pipeline of the training-data subpackage, or nothing where it has been taken out."""
    try:
        importlib.import_module("loanlens.llm")
    except ModuleNotFoundError as missing:
        if missing.name != "loanlens.llm":
            raise
        return None, None
    return importlib.import_module("loanlens.llm.queries"), importlib.import_module("corpus_pipeline")


_training, _pipeline = _training_modules()


def _training_queries() -> dict[str, Query]:
    found = dict(_training.QUERIES) if _training else {}
    return found | ({"pipeline": _pipeline.run} if _pipeline else {})


def _training_sql() -> dict[str, str]:
    found = dict(_training.ORACLES) if _training else {}
    return found | ({"pipeline": _pipeline.ORACLE_SQL} if _pipeline and _pipeline.ORACLE_SQL else {})


def queries() -> dict[str, Query]:
    return _lending_queries() | _training_queries()


def _lending_queries() -> dict[str, Query]:
    return {
        "silver_customers": _silver("customers"),
        "silver_bureau": _silver("bureau_features"),
        "silver_applications": _silver("loan_applications"),
        "silver_disbursements": _silver("disbursements"),
        "silver_repayments": _silver("repayments"),
        "silver_calls": _silver("collection_calls"),
        "gold_loan_features": _mart("gold_loan_features"),
        "risk_band_distribution": _asked("gold_loan_features", risk_band_distribution),
        "gold_repayment_enriched": _mart("gold_repayment_enriched"),
        "dpd_bucket_distribution": _asked("gold_repayment_enriched", dpd_bucket_distribution),
        "thirty_plus_boundary": _asked("gold_repayment_enriched", thirty_plus_boundary),
        "gold_approval_funnel": _mart("gold_approval_funnel"),
        "gold_portfolio_summary": _mart("gold_portfolio_summary"),
        "gold_dpd_bucket_analysis": _mart("gold_dpd_bucket_analysis"),
        "gold_vintage_analysis": _mart("gold_vintage_analysis"),
        "vintage_from_states": _from_states("gold_vintage_analysis"),
        "portfolio_from_states": _from_states("gold_portfolio_summary"),
        "funnel_from_states": _from_states("gold_approval_funnel"),
        "dpd_buckets_from_states": _from_states("gold_dpd_bucket_analysis"),
        "distinct_loans_rollup": distinct_loans_rollup,
        "enriched_from_buckets": enriched_from_buckets,
        "quality_report_from_profiles": quality_report_from_profiles,
        "profile_history": profile_history,
        "mart_row_counts": mart_row_counts,
        "adhoc_sql_mart": adhoc_sql_mart,
        "dq_null_rate": _checked("null_rates"),
        "dq_pk_duplicates": _checked("primary_key_duplicates"),
        "dq_schedule_key_duplicates": _checked("schedule_key_duplicates"),
        "dq_fk_application_customer": _checked("applications_without_customer"),
        "dq_fk_repayment_loan": _checked("repayments_without_loan"),
        "dq_principal_outlier": _checked("principal_outliers"),
        "dq_approval_monthly_drop": _checked("approval_monthly_drop"),
        "gold_data_quality_report": _checks,
        "portfolio_summary_top": _asked("gold_portfolio_summary", analysis.portfolio_top),
        "approval_drop_analysis": _asked("gold_approval_funnel", analysis.approval_drop),
        "approval_drop_top8": _asked("gold_approval_funnel", lambda funnel: analysis.approval_drop(funnel, 8)),
        "delinquency_analysis": _asked("gold_dpd_bucket_analysis", analysis.delinquency),
        "dq_failures": _listed(quality.listing),
        "dq_all_checks": _listed(lambda checks: quality.listing(checks, only_failures=False)),
        "dq_severity_histogram": _listed(quality.failures_by_severity),
        "text_chunks": text_chunks,
        "chunk_tokens": chunk_tokens,
        "chunk_ngrams": chunk_ngrams,
        "tfidf_vocabulary": tfidf_vocabulary,
        "frequent_vocabulary": frequent_vocabulary,
        "tfidf_weights": tfidf_weights,
        "tfidf_cosine": tfidf_cosine,
        "policy_top_k": policy_top_k,
        "citations_per_question": citations_per_question,
        "question_flags": question_flags,
        "question_tools": question_tools,
        "question_answer_kind": question_answer_kind,
        "conversation_routing": conversation_routing,
        "report_approval": _asked("gold_approval_funnel", questions.approval_finding),
        "report_delinquency": _asked("gold_dpd_bucket_analysis", questions.delinquency_finding),
        "report_dq": _listed(questions.quality_finding),
        "report_portfolio": _asked("gold_portfolio_summary", questions.portfolio_finding),
        "report_incident": report_incident,
        "question_answers": question_answers,
        "answer_metrics": answer_metrics,
        "evidence_json": evidence_json,
        "income_segment": _derived(lambda t: derive.customer_segments(t["customers"])),
        "risk_score_formula": risk_score_formula,
        "rejection_reason": _derived(derive.rejection_reasons),
        "disburse_approved": disburse_approved,
        "repayment_schedule": _derived(lambda t: derive.repayment_schedule(t["disbursements"])),
        "overdue_call_list": _derived(lambda t: derive.overdue_call_list(t["repayments"])),
        "contract_check": _derived(policy.contract_check),
        "schema_drift": _derived(policy.schema_drift),
        "dq_freshness": dq_freshness,
        "dq_fk_rate": _derived(policy.orphan_rates),
        "dpd_roll_matrix": _derived(lambda t: policy.roll_matrix(t["repayments"])),
        "collection_priority": collection_priority,
        "policy_decision": _derived(policy.policy_decisions),
        "approval_rate_grouping_sets": _derived(policy.approval_rates),
        "dq_incidents": _listed(policy.incidents),
    }


def oracle_sql() -> dict[str, str]:
    lending = {name: oracle.sql(name) for name in _lending_queries()}
    return lending | _training_sql()


def entry(spark: SparkSession) -> DataFrame:
    """Where delinquency is highest."""
    return queries()["delinquency_analysis"](spark, "/root/testdata/sf0.001")
