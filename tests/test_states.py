"""Marts added up from several loads, bitmaps, bucketed tables and steps between rows."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from loanlens.operators.moves import steps
from loanlens.operators.numbers import bitmaps, dense_numbers, distinct_counts
from loanlens.plans import marts, policy, states
from loanlens.sources import buckets, snapshots
from loanlens.sources.star_schema import StarSchema

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def lending(spark):
    return {name: df.persist() for name, df in StarSchema(spark, FOLDER).lending.items()}


def rows(df):
    return Counter(str(tuple(r)) for r in df.select(*sorted(df.columns)).collect())


def loads(t, parts, latest_first=False):
    """The rows of three tables dealt to several loads: loans by month, repayments at random."""
    number = lambda c: F.pmod(F.xxhash64(c), F.lit(parts))
    for part in range(parts):
        loans = F.pmod(F.month("disbursed_date"), F.lit(parts)) == (parts - 1 - part if latest_first else part)
        yield {
            "customers": t["customers"],
            "bureau_features": t["bureau_features"],
            "known_applications": t["loan_applications"],
            "loan_applications": t["loan_applications"].where(number("app_id") == part),
            "disbursements": t["disbursements"].where(loans),
            "repayments": t["repayments"].where(number("due_amount") == part),
        }


@pytest.mark.parametrize(("parts", "latest_first"), [(1, False), (3, False), (3, True)])
def test_any_order_of_loads_gives_the_marts(spark, lending, tmp_path, parts, latest_first):
    folder = str(tmp_path)
    for load in loads(lending, parts, latest_first):
        states.append(spark, load, folder)
    whole = marts.gold(lending)
    for name in states.ROLLUPS:
        assert rows(states.mart(spark, folder, name)) == rows(whole[name]), name
    states.compact(spark, folder)
    for name in states.ROLLUPS:
        assert len(snapshots.current(spark, folder)[f"{name}/sums"]) == 1
        assert rows(states.mart(spark, folder, name)) == rows(whole[name]), name
    counted = states.loans_by(spark, folder, {"all": (), "mob": ("mob",)}).collect()
    direct = whole["gold_repayment_enriched"]
    assert {r["mob"]: r["loans"] for r in counted if r["grouping"] == "mob"} == {
        r["mob"]: r["n"] for r in direct.groupBy("mob").agg(F.count_distinct("loan_id").alias("n")).collect()
    }
    assert [r["loans"] for r in counted if r["grouping"] == "all"] == [direct.agg(F.count_distinct("loan_id")).first()[0]]


def test_a_load_that_stopped_changes_nothing(spark, lending, tmp_path, monkeypatch):
    folder = str(tmp_path)
    first, second = loads(lending, 2)
    states.append(spark, first, folder)
    before = rows(states.mart(spark, folder, "gold_vintage_analysis"))
    with monkeypatch.context() as patch:
        patch.setattr(snapshots, "publish", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            states.append(spark, second, folder)
    assert rows(states.mart(spark, folder, "gold_vintage_analysis")) == before
    states.append(spark, second, folder)
    assert rows(states.mart(spark, folder, "gold_vintage_analysis")) == rows(marts.gold(lending)["gold_vintage_analysis"])


def test_a_second_load_reads_no_old_repayments(spark, lending, tmp_path, monkeypatch):
    """Only the loans' attributes and what waits for a loan."""
    folder, read = str(tmp_path), []
    first, second = loads(lending, 2)
    states.append(spark, first, folder)
    mine = {path for name, paths in snapshots.current(spark, folder).items() if not name.startswith(("loans", "waiting")) for path in paths}
    reader = type(spark.read)
    parquet = reader.parquet
    monkeypatch.setattr(reader, "parquet", lambda self, *paths, **o: read.extend(paths) or parquet(self, *paths, **o))
    states.append(spark, second, folder)
    assert not mine & set(read) and len(mine) > 4


@pytest.mark.parametrize("first", [1, 40_000])
def test_dense_numbers(spark, first):
    keys = spark.range(70_000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"), (F.col("id") % 3).alias("m"))
    got = dense_numbers(keys.unionByName(keys.limit(100)), "k", first, near="m").join(keys, "k").select("number", "m").collect()
    assert sorted(r["number"] for r in got) == list(range(first, first + 70_000))
    spans = {m: [r["number"] for r in got if r["m"] == m] for m in range(3)}
    assert all(max(spans[m]) < min(spans[m + 1]) for m in range(2))  # groups lie side by side


def test_bitmaps_roll_up(spark):
    random.seed(2)
    data = [(random.choice("ab"), random.choice([1, 2, None]), random.choice([None, *range(1, 99_000, 777)])) for _ in range(3000)]
    df = spark.createDataFrame(data, "x string, y int, number long")
    fine = bitmaps(df, ["x", "y"])
    for keys in (["x", "y"], ["y"], ["x"], []):
        want = {tuple(r[k] for k in keys): r["n"] for r in df.where("number is not null").groupBy(*keys).agg(F.count_distinct("number").alias("n")).collect()}
        assert {tuple(r[k] for k in keys): r["n"] for r in distinct_counts(fine, keys, "n").collect()} == want


def test_joins_of_bucketed_tables_have_no_exchange(spark, lending, tmp_path):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        features = buckets.write_bucketed(marts.loan_features(lending), str(tmp_path), "test_bucketed_loans", "loan_id", 8)
        repayments = buckets.write_bucketed(lending["repayments"], str(tmp_path), "test_bucketed_repayments", "loan_id", 8)
        joined = marts.repayment_enriched(repayments, features)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert rows(joined) == rows(marts.gold(lending)["gold_repayment_enriched"])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql("DROP TABLE IF EXISTS test_bucketed_loans")
        spark.sql("DROP TABLE IF EXISTS test_bucketed_repayments")


def brute_steps(data):
    found, last = Counter(), {}
    for key, state, at in sorted((r for r in data if r[0] is not None and r[1] is not None), key=lambda r: (r[0], r[2] is not None, r[2] or 0, r[1])):
        if key in last:
            found[last[key], state] += 1
        last[key] = state
    return found


@pytest.mark.parametrize("seed", range(4))
def test_steps_of_hot_and_small_groups(spark, seed):
    random.seed(seed)
    key = lambda: random.choice(["hot"] * 5 + [f"k{i}" for i in range(40)] + [None])
    data = [(key(), random.choice([1, 2, 3, None]), random.choice([None, *range(30)])) for _ in range(random.choice([0, 1, 2, 2000]))]
    got = steps(spark.createDataFrame(data, "k string, s int, at int").repartition(7), "k", "s", ["at"])
    assert {(r["came"], r["went"]): r["n"] for r in got.collect()} == brute_steps(data)


def test_a_hot_loan_is_shared_by_tasks(spark):
    data = spark.range(20_000).select(
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("loan_id"),
        F.col("id").cast("int").alias("mob"), F.lit("2026-01-01").cast("date").alias("due_date"), (F.col("id") % 95).cast("int").alias("dpd"),
    )
    plain = data.where("loan_id = 'hot'").orderBy("mob").select("dpd").collect()
    matrix = policy.roll_matrix(data)
    assert matrix.agg(F.sum("instalments")).first()[0] == len(plain) - 1
    parts = data.repartitionByRange(8, "loan_id", "mob").where("loan_id = 'hot'").select(F.spark_partition_id()).distinct().count()
    assert parts >= 4


def test_repayments_are_written_once_and_without_what_no_mart_needs(spark, lending, tmp_path):
    folder = str(tmp_path)
    for load in loads(lending, 2):
        states.append(spark, load, folder)
    found = snapshots.current(spark, folder)
    rows_of = lambda name: spark.read.parquet(*found[name])
    kept = rows_of("waiting").withColumn("waits", F.col("waits").cast("boolean"))
    assert not {"state", "city", "employment_type", "credit_segment", "principal"} & set(kept.columns)
    assert kept.where("NOT waits AND (loan_id IS NOT NULL OR paid_date IS NOT NULL)").count() == 0 < kept.where("waits").count()
    versions = {path.parent.name for path in tmp_path.glob("versions/*/*.parquet")}
    assert len(versions) == 2 and not list(tmp_path.glob("versions/*/enriched.parquet"))


def shuffles(df):
    plan = df._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    return sum("Exchange hashpartitioning(" in line for line in plan.splitlines())


def test_repayments_are_shuffled_once_for_marts_by_loan(spark):
    t = StarSchema(spark, FOLDER).lending
    loans = t["disbursements"].select("loan_id", "principal")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert shuffles(t["repayments"].join(loans, "loan_id", "left")) == 3  # lines, orders, loans; not their join
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("repeated", [1, 2])
def test_repeated_loans_count_in_states_as_often_as_joins_repeat_them(spark, lending, tmp_path, repeated):
    t = dict(lending, disbursements=lending["disbursements"].withColumn("again", F.explode(F.sequence(F.lit(1), F.lit(repeated)))).drop("again"))
    states.append(spark, t, str(tmp_path))
    whole = marts.repayment_enriched(t["repayments"], marts.loan_features(lending))
    told = whole.groupBy(F.col("disbursed_month").isNotNull().alias("found")).count().collect()
    counted = spark.read.parquet(*snapshots.current(spark, str(tmp_path))["gold_vintage_analysis/sums"]).agg(F.sum("n")).first()[0]
    # a loan that occurs twice is joined twice and numbered twice
    assert counted == sum(r["count"] for r in told if r["found"]) * repeated**2
    assert rows(states.mart(spark, str(tmp_path), "gold_vintage_analysis")) == rows(marts.gold(t)["gold_vintage_analysis"])


def test_rows_already_dealt_by_loan_are_bucketed_without_a_shuffle(spark, lending, tmp_path):
    made = buckets.write_bucketed(StarSchema(spark, FOLDER).repayments_by_loan(4), str(tmp_path), "dealt_by_loan", "loan_id", 4, dealt=True)
    assert rows(made) == rows(lending["repayments"])
    assert len(list(tmp_path.glob("dealt_by_loan/part-*.parquet"))) == 4


def test_marts_that_are_counted_read_repayments_laid_out_by_loan(spark, monkeypatch):
    import __spark_entry__ as entry

    joins = []
    found = StarSchema.repayments_by_loan
    monkeypatch.setattr(StarSchema, "repayments_by_loan", lambda self, parts: joins.append(parts) or found(self, parts))
    entry.store._made.clear()
    counts = {r["table_name"]: r["row_count"] for r in entry.mart_row_counts(spark, FOLDER).collect()}
    assert joins == [buckets.BUCKETS]  # the join of lines and orders was made once
    gold = marts.gold(StarSchema(spark, FOLDER).lending)
    assert {name: counts[name] for name in gold} == {name: df.count() for name, df in gold.items()}
