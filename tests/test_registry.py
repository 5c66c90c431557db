import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import DataFrameReader

import __spark_entry__ as registry
from check_oracle import compare, connection

FOLDER = "/root/testdata/sf0.001"
SAMPLE = [
    "silver_repayments",
    "gold_repayment_enriched",
    "gold_approval_funnel",
    "approval_drop_analysis",
    "gold_data_quality_report",
    "policy_top_k",
    "report_portfolio",
    "overdue_call_list",
    "contract_check",
    "schema_drift",
    "dq_freshness",
    "dq_fk_rate",
    "dpd_roll_matrix",
    "collection_priority",
    "policy_decision",
    "approval_rate_grouping_sets",
    "dq_incidents",
    "conversation_routing",
    "evidence_json",
    "repayment_schedule",
    "frequent_vocabulary",
    "tfidf_weights",
    "tfidf_cosine",
    "question_answers",
    "mart_row_counts",
    "vintage_from_states",
    "portfolio_from_states",
    "distinct_loans_rollup",
    "enriched_from_buckets",
]


def test_every_lending_query_has_sql():
    lending = set(registry._lending_queries())
    assert lending <= set(registry.oracle_sql())


#: Queries over stored tables, which the first of them writes.
STORED = {"tfidf_cosine", "policy_top_k", "citations_per_question", "question_answers", "answer_metrics", "evidence_json", "mart_row_counts"}
STORED |= {"vintage_from_states", "portfolio_from_states", "funnel_from_states", "dpd_buckets_from_states", "distinct_loans_rollup"}
STORED |= {"enriched_from_buckets", "frequent_vocabulary"}


def test_describing_a_query_starts_no_job(spark, monkeypatch):
    """Beyond reading the schemas of its tables."""
    reads = []
    read = DataFrameReader.parquet
    monkeypatch.setattr(DataFrameReader, "parquet", lambda self, *a, **k: reads.append(a) or read(self, *a, **k))
    context = spark.sparkContext
    for name, query in registry._lending_queries().items():
        if name in STORED:
            continue
        reads.clear()
        context.setJobGroup(f"describe {name}", name)
        query(spark, FOLDER)
        assert len(context.statusTracker().getJobIdsForGroup(f"describe {name}")) <= len(reads), name
    context.setLocalProperty("spark.jobGroup.id", None)


def test_the_rest_works_without_the_training_data_folder(tmp_path):
    """The subpackage, its tests and the pipeline can be taken out."""
    root = Path(registry.__file__).parent
    copy = tmp_path / "repo"
    left_out = shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__")
    shutil.copytree(root, copy, ignore=left_out)
    code = "import __spark_entry__ as e; assert set(e.queries()) == set(e._lending_queries()) == set(e.oracle_sql()); print(len(e.queries()))"
    run = lambda *command: subprocess.run([sys.executable, *command], cwd=copy, capture_output=True, text=True, timeout=300, env={**os.environ, "PYTHONPATH": ""})
    found = run("-c", code)
    assert found.returncode == 0 and int(found.stdout) == len(registry._lending_queries()), found.stderr
    collected = run("-m", "pytest", "tests", "--collect-only", "-q", "-p", "no:cacheprovider")
    assert collected.returncode == 0 and "error" not in collected.stdout.lower(), collected.stdout


@pytest.mark.skipif(not (Path(registry.__file__).parent / "loanlens" / "llm").exists(), reason="taken out")
def test_a_broken_training_data_folder_is_not_hidden(tmp_path):
    root = Path(registry.__file__).parent
    copy = tmp_path / "repo"
    shutil.copytree(root, copy, ignore=shutil.ignore_patterns(".git", "tests", "__pycache__"))
    (copy / "loanlens" / "llm" / "common.py").unlink()
    found = subprocess.run([sys.executable, "-c", "import __spark_entry__"], cwd=copy, capture_output=True, text=True, timeout=300, env={**os.environ, "PYTHONPATH": ""})
    assert found.returncode != 0 and "loanlens.llm.common" in found.stderr


def test_entry(spark):
    rows = registry.entry(spark).collect()
    assert len(rows) == 10 and rows[0]["instalments"] > 0


@pytest.mark.parametrize("name", SAMPLE)
def test_query_agrees_with_sql(spark, name):
    assert compare(spark, connection(FOLDER), name, FOLDER) == ""
