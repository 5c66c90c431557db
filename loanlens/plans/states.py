"""Marts from states that can be added up: new rows change a mart without a second look at old ones.

A state holds per group what a mart needs of its rows: numbers and exact sums of decimals, and the
set of loans as a bitmap over dense loan numbers. States of several loads are added, coarser groups
are sums of finer ones, and only the last step divides and rounds. Each load writes the states of
its own rows; a manifest that is written last names all that belong together.

Repayments can come before their loan. Until then they are kept as they came, and count as
repayments without a loan; the load that brings the loan moves them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from loanlens.functions.lending import dpd_bucket, is_30_plus, is_approved, month_of
from loanlens.functions.numbers import WIDE, percent, round_half_up
from loanlens.operators.numbers import bitmaps, dense_numbers, distinct_counts, same
from loanlens.plans import marts
from loanlens.session import stored
from loanlens.sources import snapshots
from loanlens.sources.store import AT_ONCE

Tables = Mapping[str, DataFrame]


def _money(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0.0)).cast(WIDE)


def _one() -> Column:
    return F.lit(1).cast("long")


def _there(name: str) -> Column:
    return F.col(name).isNotNull().cast("long")


def _amount(total: str) -> Column:
    return F.col(total).cast("double")


def _mean(total: str, number: str) -> Column:
    return round_half_up(_amount(total) / F.nullif(F.col(number), F.lit(0)), 2)


@dataclass(frozen=True)
class Rollup:
    """A mart's groups, what is added up in them, and the columns made of the sums."""

    keys: tuple[str, ...]
    sums: dict[str, Callable[[], Column]]
    columns: dict[str, Callable[[], Column]]
    #: The column with the number of different loans, if the mart has one.
    loans: str | None = None

    def state(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self.keys).agg(*[F.sum(value()).alias(name) for name, value in self.sums.items()])

    def mart(self, states: DataFrame, bits: DataFrame | None) -> DataFrame:
        """The mart of all states together, with its columns in their order."""
        added = states.groupBy(*self.keys).agg(*[F.sum(name).alias(name) for name in self.sums])
        if self.loans is None:
            return added.select(*self.keys, *[value().alias(name) for name, value in self.columns.items()])
        counted = distinct_counts(bits, self.keys, self.loans)
        both = added.alias("s").join(counted.alias("b"), same(self.keys, "s", "b"), "left")
        named = both.select("s.*", F.coalesce(F.col(self.loans), F.lit(0)).alias(self.loans))
        return named.select(*self.keys, self.loans, *[value().alias(name) for name, value in self.columns.items()])


ROLLUPS = {
    "gold_approval_funnel": Rollup(
        ("application_month", "product", "channel", "employment_type", "credit_segment"),
        {"n": _one, "approved": lambda: F.col("approved").cast("long"), "risk": lambda: _money("risk_score"),
         "risks": lambda: _there("risk_score"), "amount": lambda: F.col("approved_amount").cast(WIDE)},
        {"applications": lambda: F.col("n"), "approved_applications": lambda: F.col("approved"),
         "approval_rate_pct": lambda: round_half_up(percent(F.col("approved"), F.col("n")), 2),
         "avg_risk_score": lambda: _mean("risk", "risks"), "approved_amount": lambda: _amount("amount")},
    ),
    "gold_portfolio_summary": Rollup(
        ("disbursed_month", "product", "channel", "risk_band"),
        {"principals": lambda: F.col("principal").cast(WIDE), "risk": lambda: _money("risk_score"), "risks": lambda: _there("risk_score"),
         "bureau": lambda: F.coalesce(F.col("bureau_score").cast("double"), F.lit(0.0)).cast(WIDE), "bureaus": lambda: _there("bureau_score")},
        {"principal_disbursed": lambda: round_half_up(_amount("principals"), 2), "avg_risk_score": lambda: _mean("risk", "risks"),
         "avg_bureau_score": lambda: _mean("bureau", "bureaus")},
        loans="loans",
    ),
    "gold_dpd_bucket_analysis": Rollup(
        ("due_month", "product", "channel", "risk_band", "dpd_bucket"),
        {"n": _one, "due": lambda: F.col("due_amount").cast(WIDE), "paid": lambda: _money("paid_amount"), "late": lambda: F.col("is_30_plus_dpd").cast("long")},
        {"scheduled_instalments": lambda: F.col("n"), "amount_due": lambda: round_half_up(_amount("due"), 2),
         "amount_paid": lambda: round_half_up(_amount("paid"), 2), "thirty_plus_dpd_rate_pct": lambda: round_half_up(percent(F.col("late"), F.col("n")), 2)},
    ),
    "gold_vintage_analysis": Rollup(
        ("disbursed_month", "mob", "risk_band"),
        {"n": _one, "late": lambda: F.col("is_30_plus_dpd").cast("long")},
        {"thirty_plus_dpd_rate_pct": lambda: round_half_up(percent(F.col("late"), F.col("n")), 2)},
        loans="loans_observed",
    ),
}
OF_REPAYMENTS = ("gold_dpd_bucket_analysis", "gold_vintage_analysis")


#: What the marts of repayments know of a loan.
OF_LOAN = ("disbursed_month", "product", "channel", "risk_band", "number")


def _slim(enriched: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Repayments with what the marts need, ``waits`` if there is no loan yet; of others the month of ``due_date`` is enough and no loan or day of payment."""
    waits = F.col("number").isNull()
    shown = {"loan_id": F.when(waits, F.col("loan_id")), "paid_date": F.when(waits, F.col("paid_date"))}
    shown["due_date"] = F.when(waits, F.col("due_date")).otherwise(month_of(F.col("due_date")))
    return enriched.select(*[shown.get(c, F.col(c)).alias(c) for c in columns], *OF_LOAN, waits.alias("waits"))


def _told(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"due_month": month_of(F.col("due_date")), "dpd_bucket": dpd_bucket(F.col("dpd")), "is_30_plus_dpd": is_30_plus(F.col("dpd"))})


def _waiting(repayments: DataFrame, paths: Sequence[str]) -> DataFrame:
    """Repayments that still wait for their loan; of the folder only their part is opened."""
    kinds = StructType([*repayments.schema.fields, StructField("waits", BooleanType())])
    return repayments.sparkSession.read.schema(kinds).parquet(*paths).where("waits").drop("waits")


@contextmanager
def _unsorted_parts(spark: SparkSession) -> Iterator[None]:
    """Writes of two partitions keep a file open for each, and so need not sort the rows by partition."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "2")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def append(spark: SparkSession, t: Tables, folder: str) -> None:
    """Add new rows of the lending tables to the states at ``folder``.

    ``t`` holds new applications, disbursements and repayments, and the customers and bureau records
    they refer to. New loans whose applications came with an earlier load find them among
    ``known_applications``. Of old rows the load reads the loans' attributes, for new repayments of
    old loans, and repayments that still wait for their loan.
    """
    before, version = snapshots.current(spark, folder) or {}, snapshots.new_version()
    made: dict[str, list[str]] = {name: list(paths) for name, paths in before.items() if not name.startswith("waiting")}

    def written(df: DataFrame, name: str) -> DataFrame:
        path = f"{folder}/versions/{version}/{name}.parquet"
        df.write.parquet(path)
        made.setdefault(name, []).append(path)
        return spark.read.schema(df.schema).parquet(path)

    loans_before = spark.read.parquet(*before["loans"]).count() if before else 0
    known = t["known_applications"] if "known_applications" in t else t["loan_applications"]
    features = stored(marts.loan_features({**t, "loan_applications": known}), "features")  # joins that numbering would repeat
    numbers = dense_numbers(features, "loan_id", loans_before + 1, near="disbursed_month")
    written(features.join(numbers, "loan_id"), "loans")
    loans = spark.read.parquet(*made["loans"])
    fresh = spark.read.parquet(made["loans"][-1])

    repayments = t["repayments"]
    if before:
        repayments = repayments.unionByName(_waiting(repayments, before["waiting"]))
    numbered_loans = loans.select("loan_id", *[c for c in OF_LOAN if c != "number"]).join(loans.select("loan_id", "number"), "loan_id")
    enriched = _slim(repayments.join(numbered_loans, "loan_id", "left"), repayments.columns)
    path = f"{folder}/versions/{version}/waiting.parquet"  # rows with a loan lie beside those that wait, and no load reads them
    with _unsorted_parts(spark):
        enriched.write.partitionBy("waits").parquet(path)
    made["waiting"] = [path]
    told = _told(spark.read.schema(enriched.schema).parquet(path))
    found, waiting = told.where("NOT waits"), told.where("waits")

    applications = t["loan_applications"].join(t["customers"].select("customer_id", "employment_type", "credit_segment"), "customer_id", "left")
    funnel = applications.withColumns(
        {"application_month": month_of(F.col("application_date")), "approved": is_approved(F.col("approval_status"))}
    )
    rows = {"gold_approval_funnel": funnel, "gold_portfolio_summary": fresh, **dict.fromkeys(OF_REPAYMENTS, found)}
    states: dict[str, DataFrame] = {}
    for name, rollup in ROLLUPS.items():
        states[f"{name}/sums"] = rollup.state(rows[name])
        if rollup.loans:
            states[f"{name}/loans"] = bitmaps(rows[name], rollup.keys)
    # what waits is told anew by every load, under numbers that no loan has yet; only sets of loans need the numbers
    for name in OF_REPAYMENTS:
        rollup = ROLLUPS[name]
        states[f"waiting {name}/sums"] = rollup.state(waiting)
        if rollup.loans:
            numbered = waiting.select("loan_id", *rollup.keys).join(dense_numbers(waiting, "loan_id", loans.count() + 1), "loan_id", "left")
            states[f"waiting {name}/loans"] = bitmaps(numbered, rollup.keys)
    with ThreadPoolExecutor(AT_ONCE) as threads:  # states side by side; each still uses the whole cluster
        for done in [threads.submit(written, df, name) for name, df in states.items()]:
            done.result()
    snapshots.publish(spark, folder, version, made)


def _parts(spark: SparkSession, folder: str, name: str) -> DataFrame:
    found = snapshots.current(spark, folder)
    if found is None:
        raise ValueError(f"no complete states at {folder}")
    return spark.read.parquet(*found[name], *found.get(f"waiting {name}", []))


def mart(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A mart from all states of the current version."""
    rollup = ROLLUPS[name]
    return rollup.mart(_parts(spark, folder, f"{name}/sums"), _parts(spark, folder, f"{name}/loans") if rollup.loans else None)


def compact(spark: SparkSession, folder: str) -> None:
    """Add the states of all loads into one each, so that readers open fewer files. Marts stay the same."""
    found, version = snapshots.current(spark, folder), snapshots.new_version()
    made = dict(found)
    for name, rollup in ROLLUPS.items():
        states = spark.read.parquet(*found[f"{name}/sums"])
        parts = {f"{name}/sums": states.groupBy(*rollup.keys).agg(*[F.sum(c).cast(dict(states.dtypes)[c]).alias(c) for c in rollup.sums])}
        if rollup.loans:
            parts[f"{name}/loans"] = spark.read.parquet(*found[f"{name}/loans"]).groupBy(*rollup.keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
        for part, df in parts.items():
            made[part] = [f"{folder}/versions/{version}/{part}.parquet"]
            df.write.parquet(made[part][0])
    snapshots.publish(spark, folder, version, made)


def loans_by(spark: SparkSession, folder: str, groupings: Mapping[str, tuple[str, ...]], name: str = "gold_vintage_analysis") -> DataFrame:
    """``grouping``, all keys of the mart, ``loans``: different loans by several groupings, all from the one stored state."""
    rollup, bits = ROLLUPS[name], _parts(spark, folder, f"{name}/loans")
    parts = []
    for label, keys in groupings.items():
        counted = distinct_counts(bits, keys, "loans")
        shown = [F.col(k) if k in keys else F.lit(None).cast(dict(bits.dtypes)[k]).alias(k) for k in rollup.keys]
        parts.append(counted.select(F.lit(label).alias("grouping"), *shown, "loans"))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
