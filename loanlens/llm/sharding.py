"""Shards that each hold the mixture of the whole: proportional stratified interleaving."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanlens.llm.common import ROW, bucket_of, carried, ranked, unpacked

SEED = 11


def interleaved_shards(
    rows: DataFrame,
    shards: int,
    source_column: str = "source",
    id_columns: tuple[str, ...] = ("doc_id",),
    seed: int = SEED,
) -> DataFrame:
    """Add ``shard`` (0 to ``shards`` - 1) and ``slot`` (gapless from 0 in each shard).

    Rows are put in a seeded random order within their source; the row of rank ``r`` among ``n``
    stands at ``(r + u) / n``, with one random ``u`` per source so that rare sources do not pile
    up in one place. All rows sorted by that fraction are cut into equal parts. Shard sizes differ
    by one row at most, and the rows of a source in a shard by about one from its share.

    A null source is a source of its own. Order and result depend on ``id_columns`` and the seed
    only; rows that agree in these and the source are interchangeable, so repeated rows are placed
    like others. No rows, no shards. Columns named ``shard`` or ``slot`` are replaced.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    ids = [F.col(f"{ROW}.`{c}`") for c in id_columns]
    random = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *ids), 11).cast("double") / F.lit(float(2**53))
    source = F.col(f"{ROW}.`{source_column}`").cast("string")
    shuffled = carried(rows).select(
        ROW,
        F.coalesce(F.concat(F.lit("="), source), F.lit("")).alias("stratum"),
        random.alias("random"),
    )
    in_source = ranked(shuffled, ["stratum"], ["random", *ids], bucket_of(F.col("random")), "rank", "rows_of")
    start = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "stratum"), 11).cast("double") / F.lit(float(2**53))
    placed = in_source.withColumn("fraction", (F.col("rank") + start) / F.col("rows_of"))
    return unpacked(_cut(placed, shards, ["fraction", "stratum", "rank"]), rows.columns, "shard", "slot")


def _cut(placed: DataFrame, shards: int, order: list[str]) -> DataFrame:
    """Shard and slot by position in the order; the count table has a fixed number of rows."""
    cut = placed.withColumn("piece", bucket_of(F.col("fraction")))
    every = Window.orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    sizes = cut.groupBy("piece").agg(F.count(F.lit(1)).alias("piece_rows"))
    offsets = sizes.select(
        "piece",
        F.coalesce(F.sum("piece_rows").over(every), F.lit(0)).alias("before"),
        F.sum("piece_rows").over(Window.partitionBy(F.lit(0))).alias("total"),
    )
    within = F.row_number().over(Window.partitionBy("piece").orderBy(*order)) - 1
    return (
        cut.withColumn("within", within)
        .join(offsets, "piece")
        .withColumn("position", F.col("before") + F.col("within"))
        .withColumn("shard", F.expr(f"position * {shards} div total").cast("int"))
        .withColumn("slot", F.expr(f"position - (shard * total + {shards - 1}) div {shards}"))
    )
