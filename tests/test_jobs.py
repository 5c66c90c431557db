import shutil

import pytest

from lending import DATA, portfolio
from loanlens.plans import analysis, jobs, quality
from loanlens.sources import snapshots, tables

BUILT = [*jobs.GOLD, jobs.REPORT]


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    raw, out = (str(tmp_path_factory.mktemp(name)) for name in ("raw", "out"))
    for name, df in portfolio(spark).items():
        df.write.option("header", True).csv(f"{raw}/{name}.csv")
    corpus = spark.createDataFrame([("p.md", "approval policy")], "source string, text string")
    assert jobs.ensure_built(spark, raw, corpus, out)
    return raw, out, corpus


def test_csv_to_typed_tables_and_back(spark, built):
    _, out, _ = built
    for name, df in portfolio(spark).items():
        stored = spark.read.parquet(f"{out}/silver/{name}.parquet")
        assert stored.dtypes == df.dtypes
        blank = {"": None}
        expected = sorted(str(tuple(blank.get(v, v) for v in row)) for row in DATA[name])
        assert sorted(str(tuple(r)) for r in stored.collect()) == expected


def test_marts_are_written_with_report_in_two_formats(spark, built):
    _, out, _ = built
    gold = jobs.read_gold(spark, out)
    counts = {r["table_name"]: r["row_count"] for r in analysis.row_counts({n: gold[n] for n in jobs.GOLD}, gold[jobs.REPORT]).collect()}
    assert counts["gold_loan_features"] == 5 and counts["gold_repayment_enriched"] == 15
    assert counts["dq_checks"] == 30 and set(counts) == {*BUILT, "dq_checks"}
    csv = spark.read.option("header", True).csv(f"{out}/gold/{jobs.REPORT}.csv")
    assert csv.columns == gold[jobs.REPORT].columns and csv.count() == 30
    direct = {tuple(r) for r in quality.report(portfolio(spark)).collect()}
    assert {tuple(r) for r in gold[jobs.REPORT].collect()} == direct


def test_second_run_builds_nothing(spark, built):
    raw, out, corpus = built
    assert not jobs.ensure_built(spark, raw, corpus, out)


PARTS = [f"silver/{n}.parquet" for n in tables.SCHEMAS] + [f"gold/{n}.parquet" for n in BUILT] + ["manifests"]


@pytest.mark.parametrize("part", PARTS)
def test_a_build_that_stopped_is_not_complete(spark, built, tmp_path, monkeypatch, part):
    """Without any one of its tables, or without the manifest, a build is made again."""
    _, out, corpus = built
    copy = tmp_path / "out"
    shutil.copytree(out, copy)
    for manifest in copy.glob("manifests/*/part-*"):
        manifest.write_text(manifest.read_text().replace(f"{out}/", f"{copy}/"))
        (manifest.parent / f".{manifest.name}.crc").unlink(missing_ok=True)
    made = []
    monkeypatch.setattr(jobs, "build_all", lambda *a: made.append("marts"))
    monkeypatch.setattr(jobs.retrieval, "write_index", lambda *a: made.append("index"))
    assert not jobs.ensure_built(spark, "", corpus, str(copy)) and not made
    shutil.rmtree(copy / part)
    assert jobs.ensure_built(spark, "", corpus, str(copy)) and made == ["marts", "index"]


def test_a_version_is_seen_as_a_whole_or_not_at_all(spark, tmp_path):
    root = str(tmp_path)
    assert snapshots.current(spark, root) is None
    for number in (1, 2):
        version = snapshots.new_version()
        path = f"{root}/versions/{version}/t.parquet"
        spark.range(number).write.parquet(path)
        assert snapshots.current(spark, root) is None if number == 1 else snapshots.read(spark, root, "t").count() == 1
        snapshots.publish(spark, root, version, {"t": [path]})
        assert snapshots.read(spark, root, "t").count() == number
    # a manifest whose job has not ended
    (tmp_path / "manifests" / "99999" / "_temporary").mkdir(parents=True)
    assert snapshots.read(spark, root, "t").count() == 2


def test_any_sql_on_the_marts(spark, built):
    gold = jobs.read_gold(spark, built[1])
    got = analysis.run_sql(spark, "SELECT COUNT(*) AS n FROM gold_vintage_analysis v JOIN gold_loan_features USING (disbursed_month)", gold)
    assert got.first()["n"] > 0


def test_month_layout_prunes(spark, built):
    features = jobs.read_gold(spark, built[1])["gold_loan_features"].filter("disbursed_month = DATE '2026-06-01'")
    plan = features._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(disbursed_month" in plan and features.count() == 2


def notes(spark, tmp_path, *lines):
    (tmp_path / "calls.csv").write_text("call_id,loan_id,call_date,outcome,agent_notes\n" + "\n".join(lines) + "\n", encoding="utf-8")
    return tables.read_csv(spark, str(tmp_path / "calls.csv"), "collection_calls")


def test_quotes_and_line_breaks_in_csv(spark, tmp_path):
    got = notes(spark, tmp_path, 'k1,l1,2026-07-02,Connected,"said ""pay, later"""', 'k2,l1,2026-07-02,Connected,"two\nlines"').collect()
    assert [(r["call_id"], r["agent_notes"]) for r in got] == [("k1", 'said "pay, later"'), ("k2", "two\nlines")]


@pytest.mark.parametrize("line", ["k1,l1", "k1,l1,2026-07-02,Connected,ok,more"])
def test_short_and_long_csv_rows_stop_the_job(spark, tmp_path, line):
    with pytest.raises(Exception, match="MALFORMED"):
        notes(spark, tmp_path, "k0,l1,2026-07-02,Connected,ok", line).collect()


def test_another_header_stops_the_job(spark, tmp_path):
    (tmp_path / "c.csv").write_text("loan_id,call_id,call_date,outcome,agent_notes\na,b,c,d,e\n", encoding="utf-8")
    with pytest.raises(Exception, match="header|schema"):
        tables.read_csv(spark, str(tmp_path / "c.csv"), "collection_calls").collect()


def test_a_bad_value_stops_the_job(spark):
    raw = spark.createDataFrame([("c", "s", "t", "old", "e", "1", "x", "2025-01-01")], [n for n, _ in tables.columns_of("customers")])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        tables.typed(raw, "customers").collect()
