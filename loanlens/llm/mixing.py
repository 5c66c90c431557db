"""A mix of sources at target weights: whole copies first, then Pareto order sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanlens.llm.common import ROW, bucket_of, carried, ranked, unit, unpacked
from loanlens.session import stored

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_COPIES = 2
#: After the sample, the words still missing are filled with what fits, in the same order, so often.
FILLS = 2
#: Buckets of the order, per source, whose sums tell where a sample ends.
ORDER_BUCKETS = 1 << 14
#: A table with a row for each of so many sources is broadcast; it has some MB.
FEW_SOURCES = 50_000
SEED = "mix"
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sized: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: int = MOST_COPIES) -> DataFrame:
    """``stratum, source_size, target`` for the ``stratum, size`` rows; one row per source is sorted here.

    Sources in code point order take the weights in turn and divide ``share`` of all sizes. No
    target passes ``most`` times its source: with sources sorted by size for weight, the first
    ``k`` are full where the level left for the others does not reach the next one.
    """
    per_source = sized.groupBy("stratum").agg(F.sum("size").alias("source_size"))
    by_name, by_ratio = Window.orderBy("stratum"), Window.orderBy("ratio", "stratum")
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weighed = (
        per_source.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int")))
        .withColumn("full", (F.col("source_size") * most).cast("double"))
        .withColumn("ratio", F.col("full") / F.col("weight"))
    )
    so_far = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    goal = F.sum("source_size").over(every) * F.lit(float(share))
    level = (goal - F.coalesce(F.sum("full").over(so_far), F.lit(0.0))) / F.sum("weight").over(rest)
    levelled = weighed.withColumn("level", level)
    first_fit = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "stratum", "level"))).over(every)
    return levelled.withColumn("last", first_fit).select(
        "stratum",
        "source_size",
        F.least(F.col("full"), F.coalesce(F.col("last.level") * F.col("weight"), F.col("full"))).alias("target"),
    )


def _drawn(rows: DataFrame, size: Column, source_column: str, id_columns: tuple[str, ...], seed: str) -> DataFrame:
    """The rows carried whole, with ``stratum``, ``size`` and a repeatable ``random`` number."""
    marked = carried(rows.withColumn("size", size))
    source = F.col(f"{ROW}.`{source_column}`").cast("string")
    last = F.concat(F.when(source.isNull(), F.lit("1")).otherwise(F.lit("0")), F.coalesce(source, F.lit("")))
    random = unit(F.lit(seed), *[F.col(f"{ROW}.`{c}`") for c in id_columns])
    return marked.select(ROW, last.alias("stratum"), F.col(f"{ROW}.size").alias("size"), random.alias("random"))


def sample_copies(
    rows: DataFrame,
    size: Column,
    source_column: str = "source",
    id_columns: tuple[str, ...] = ("doc_id",),
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    seed: str = SEED,
) -> DataFrame:
    """Add ``size, source_size, target`` and ``copies`` (0 to 2): how often the mix takes a row.

    A source with target ``t`` and size ``s`` takes every row ``floor(t / s)`` times. The rest of
    the target is a sample without replacement in Pareto order: rows are ranked by their random
    odds divided by their inclusion odds and taken from the front. The inclusion odds are those of
    the source's remaining rate times the square root of the row's size, so long texts come first
    more often. The sample's size is fixed in words: it ends before the row that would pass the
    target, and the words still missing are filled with the next rows that fit.

    Where a source's sample ends is a number per source. It is found on sizes and random numbers
    alone; the rows themselves are then told by one pass that meets that small table, and are
    neither shuffled nor written.

    Rows with no words are never missed: they count nothing. A null source is one of its own, the
    last. Rows that agree in ``id_columns``, source and size have the same place in the order; where
    a sample ends among them, as many are taken as still fit, those with the smallest digests of
    their columns first. Reruns agree. Columns of the input named like the added ones are replaced.
    No rows, no mix.
    """
    drawn = _drawn(rows, size, source_column, id_columns, seed)
    narrow = stored(drawn.select("stratum", "size", "random"), "drawn")
    plan = _per_source(_rates(targets(narrow, weights, share)), "plan")
    for _ in range(FILLS + 1):
        plan = _per_source(_cut(_ordered(narrow, plan), plan), "plan")
    told = _ordered(drawn, plan)
    if not plan.where(F.exists("cuts", lambda cut: cut["some"] > 0)).isEmpty():
        told = _some_of_ties(told)
    told = told.withColumn("copies", (F.col("whole") + F.col("taken").cast("int")).cast("int"))
    return unpacked(told, [*rows.columns, "size"], "size", "source_size", "target", "copies")


def _tie(cut: Column) -> Column:
    """Whether a row is one of those of which the cut takes only some."""
    return (cut["some"] > 0) & (F.col("pareto") == cut["tie"]["pareto"]) & (F.col("size") == cut["tie"]["size"])


def _some_of_ties(told: DataFrame) -> DataFrame:
    """Take of each tie at a cut as many rows as the cut says. Only such rows are numbered, in as many tasks as they need."""
    tied = F.coalesce(F.exists("cuts", _tie), F.lit(False))
    some = F.element_at(F.filter("cuts", _tie), 1)["some"]
    held = told.where(tied).withColumn("some", some).withColumn("place", F.monotonically_increasing_id())
    held = stored(held.withColumn("digest", F.xxhash64(ROW)), "ties")
    even = F.shiftrightunsigned(F.xxhash64("digest", "place"), 11).cast("double") / F.lit(float(2**53))
    keys, number = ["stratum", "pareto", "size"], "number"
    # few rows need no buckets, and then reruns take the same rows whatever their places
    bucket = bucket_of(even) if held.count() > FEW_SOURCES else F.lit(0)
    numbered = ranked(held, keys, ["digest", "place"], bucket, number, "of_tie").withColumn("taken", F.col(number) < F.col("some"))
    return told.where(~tied).unionByName(numbered.select(*told.columns))


def _per_source(table: DataFrame, name: str) -> DataFrame:
    """A table with a row per source, written once; broadcast if there are few of them."""
    table = stored(table, name)
    return F.broadcast(table) if table.count() <= FEW_SOURCES else table


#: Taken are the rows of at most ``most`` words up to the place ``last``, and ``some`` of those at the place ``tie``.
PLACE = "struct<pareto:double,size:bigint>"
CUT = f"struct<most:double,last:{PLACE},tie:{PLACE},some:bigint>"


def _rates(goals: DataFrame) -> DataFrame:
    """Per source the whole copies, the rate left and its words, and no cuts yet."""
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return (
        goals.withColumn("whole", F.floor(rate))
        .withColumn("part", rate - F.col("whole"))
        .withColumn("open", F.col("target") - F.col("whole") * F.col("source_size"))
        .withColumn("cuts", F.array().cast(f"array<{CUT}>"))
    )


def _ordered(drawn: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows with their place in the Pareto order, and whether a cut so far has taken them."""
    odds = F.col("part") / (1 - F.col("part")) * F.sqrt(F.greatest(F.col("size"), F.lit(1)).cast("double"))
    pareto = F.when(F.col("part") > 0, F.col("random") / (1 - F.col("random")) / odds)
    taken = F.exists("cuts", lambda cut: (F.col("size") <= cut["most"]) & (F.struct("pareto", "size") <= cut["last"]))
    joined = drawn.join(plan, "stratum").withColumn("pareto", pareto)
    return joined.withColumn("taken", F.coalesce(taken, F.lit(False)))


def _cut(ordered: DataFrame, plan: DataFrame) -> DataFrame:
    """``plan`` with one more cut per source: how far the open words reach among the rows that fit.

    Sums of sizes per source and bucket of the order tell in which bucket the sample ends; only that
    bucket's places are sorted. Rows at one place are a tie, and if the sample ends inside it, the
    cut says how many of it are taken.
    """
    fits = ordered.where(~F.col("taken") & F.col("pareto").isNotNull() & (F.col("size") <= F.col("open")))
    # odds / (1 + odds) brings the order back to (0, 1)
    bucket = F.least(F.floor(F.col("pareto") / (1 + F.col("pareto")) * ORDER_BUCKETS), F.lit(ORDER_BUCKETS - 1)).cast("int")
    fits = fits.select("stratum", "size", "open", bucket.alias("bucket"), F.struct("pareto", "size").alias("place"))
    sums = fits.groupBy("stratum", "bucket", "open").agg(F.sum("size").alias("here"), F.max("place").alias("last_here"))
    reach = F.sum("here").over(Window.partitionBy("stratum").orderBy("bucket"))
    beyond = F.col("reach") > F.col("open")
    ends = _per_source(
        sums.withColumn("reach", reach)
        .groupBy("stratum")
        .agg(
            F.min(F.when(beyond, F.col("bucket"))).alias("end"),
            F.coalesce(F.max(F.when(~beyond, F.col("reach"))), F.lit(0)).alias("before"),
            F.max(F.when(~beyond, F.col("last_here"))).alias("last_before"),
        ),
        "ends",
    )
    edge = fits.join(ends, "stratum").where("bucket = end").groupBy("stratum", "place", "open", "before").agg(F.sum("size").alias("here"))
    run = F.col("before") + F.sum("here").over(Window.partitionBy("stratum").orderBy("place"))
    inside = F.col("run") <= F.col("open")
    reached = edge.withColumn("run", run).groupBy("stratum").agg(
        F.max(F.when(inside, F.col("run"))).alias("run"),
        F.max(F.when(inside, F.col("place"))).alias("last_inside"),
        F.min(F.when(~inside, F.col("place"))).alias("tie"),
    )
    found = ends.join(reached, "stratum", "left").select(
        "stratum",
        F.coalesce("run", "before").alias("whole_places"),
        F.coalesce("last_inside", "last_before").alias("last"),
        "tie",
    )
    joined = plan.join(found, "stratum", "left")
    left = F.col("open") - F.coalesce("whole_places", F.lit(0))
    some = F.coalesce(F.floor(left / F.col("tie.size")), F.lit(0))
    cut = F.struct(F.col("open").alias("most"), "last", "tie", some.alias("some")).cast(CUT)
    return (
        joined.withColumn("cuts", F.concat("cuts", F.array(cut)))
        .withColumn("open", left - some * F.coalesce("tie.size", F.lit(0)))
        .drop("whole_places", "last", "tie")
    )


def mixed(docs: DataFrame, text_column: str = "text", **options) -> DataFrame:
    """The mix itself: rows of ``docs``, each as often as it is taken. Columns as in ``docs``."""
    row = lambda name: F.col(f"{ROW}.`{name}`").alias(name)
    inside = carried(docs).select(F.col(ROW).alias("document"), row(text_column), row("source"), row("doc_id"))
    taken = sample_copies(inside, words(F.col(f"`{text_column}`")), **options).where("copies > 0")
    repeated = taken.select("document", F.explode(F.sequence(F.lit(1), "copies")).alias("copy"))
    return repeated.select(*[F.col(f"document.`{c}`").alias(c) for c in docs.columns])
