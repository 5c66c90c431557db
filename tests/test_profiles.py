"""The quality report from profiles of any number of loads is the report from all rows."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from lending import portfolio
from loanlens.plans import profiles, quality
from loanlens.sources import snapshots
from loanlens.sources.tables import SCHEMAS


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def dealt(t, parts, seed=0):
    """Each table's rows dealt to loads by their contents and position."""
    number = {name: df.withColumn("at", F.pmod(F.xxhash64(F.monotonically_increasing_id(), F.lit(seed)), F.lit(parts))) for name, df in t.items()}
    return [{name: df.where(F.col("at") == part).drop("at") for name, df in number.items()} for part in range(parts)]


@pytest.mark.parametrize(("parts", "seed"), [(3, 1)])
def test_report_of_loads(spark, tmp_path, parts, seed):
    t = {name: df.coalesce(1) for name, df in portfolio(spark).items()}
    for load in dealt(t, parts, seed):
        profiles.append(spark, load, str(tmp_path))
    assert rows(profiles.report(spark, str(tmp_path))) == rows(quality.report(t))
    history = profiles.history(spark, str(tmp_path))
    summed = {(r[0], r[1]): tuple(r)[2:] for r in history.groupBy("table_name", "column_name").agg(F.sum("rows"), F.sum("nulls"), F.min("low"), F.max("high")).collect()}
    assert summed["repayments", "dpd"] == (15, 1, -1.0, 91.0)
    assert summed["customers", "state"] == (3, 1, None, None)


def test_children_before_parents_and_tables_one_by_one(spark, tmp_path):
    t, folder = portfolio(spark), str(tmp_path)
    with pytest.raises(ValueError):
        profiles.report(spark, folder)
    for name in ("repayments", "loan_applications", "collection_calls", "bureau_features", "disbursements"):
        profiles.append(spark, {name: t[name]}, folder)
    orphans = {r["table_name"]: r["metric_value"] for r in profiles.report(spark, folder).where("rule_name LIKE 'fk%'").collect()}
    assert orphans == {"repayments": 2.0, "loan_applications": 7.0}
    profiles.append(spark, {"customers": t["customers"]}, folder)
    assert rows(profiles.report(spark, folder)) == rows(quality.report(t))


def test_the_same_load_twice_repeats_every_key(spark, tmp_path):
    t, folder = portfolio(spark), str(tmp_path)
    for _ in range(2):
        profiles.append(spark, t, folder)
    doubled = {name: df.unionAll(df) for name, df in t.items()}
    assert rows(profiles.report(spark, folder)) == rows(quality.report(doubled))


def test_empty_tables(spark, tmp_path):
    t, folder = portfolio(spark), str(tmp_path)
    empty = {name: df.where("false") for name, df in t.items()}
    profiles.append(spark, empty, folder)
    assert rows(profiles.report(spark, folder)) == rows(quality.report(empty))
    profiles.append(spark, t, folder)
    assert rows(profiles.report(spark, folder)) == rows(quality.report(t))


def test_a_load_that_stopped_changes_nothing(spark, tmp_path, monkeypatch):
    first, second = dealt({name: df.coalesce(1) for name, df in portfolio(spark).items()}, 2)
    folder = str(tmp_path)
    profiles.append(spark, first, folder)
    before = rows(profiles.report(spark, folder))
    with monkeypatch.context() as patch:
        patch.setattr(snapshots, "publish", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            profiles.append(spark, second, folder)
    assert rows(profiles.report(spark, folder)) == before


def test_sketches_miss_no_key_and_suspect_few(spark):
    keys = spark.range(60_000).select(F.col("id").cast("string").alias("k")).withColumn("hash", F.xxhash64("k"))
    sketches = profiles._sketch(keys.where("CAST(k AS INT) < 20000"), 20_000).unionAll(profiles._sketch(keys.where("CAST(k AS INT) >= 55000"), 5_000))
    found = {int(r["k"]) for r in profiles.suspected(keys, sketches).collect()}
    assert {*range(20_000), *range(55_000, 60_000)} <= found
    assert len(found) - 25_000 < 35_000 * 0.15


def test_new_rows_do_not_read_old_tables(spark, tmp_path, monkeypatch):
    """A load reads keys, sketches and what waits, but no older profile."""
    folder, read = str(tmp_path), []
    t = portfolio(spark)
    profiles.append(spark, t, folder)
    old = {path for name, paths in snapshots.current(spark, folder).items() if name in ("cells", "months", "numbers") for path in paths}
    reader = type(spark.read)
    parquet = reader.parquet
    monkeypatch.setattr(reader, "parquet", lambda self, *paths, **o: read.extend(paths) or parquet(self, *paths, **o))
    profiles.append(spark, t, folder)
    assert len(old) == 3 and read and not old & set(read)
    assert set(SCHEMAS) == set(t)


def test_loads_of_the_registered_profiles_make_repayments_once(spark, monkeypatch):
    import __spark_entry__ as registry

    plans = []
    monkeypatch.setattr(registry.store, "kept", lambda spark, name, made_from, make: make())
    monkeypatch.setattr(registry.profiles, "append", lambda spark, t, folder: plans.append(t["repayments"]._jdf.queryExecution().optimizedPlan().toString()))
    registry._profiles(spark, "/root/testdata/sf0.001")
    assert len(plans) == 3 and not any("Join" in plan for plan in plans)
