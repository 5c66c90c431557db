"""Data quality kept over time: each load is profiled once, and the report is made of the profiles.

A profile holds, per load, rows, missing values and bounds of each checked column, principals out of
bounds and approvals by month. They are added up. Keys are kept too, each once, with a sketch of one
bit per key: a key whose bit no earlier load has set is new without a look at the old keys. Only the
others, which are those met before and a few more, are looked up among the old keys, so counts of
different and of repeated keys are exact. Rows that refer to a key nobody has yet wait, one row per
key, until a load brings it.
"""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.plans import quality
from loanlens.sources import snapshots
from loanlens.sources.store import AT_ONCE
from loanlens.sources.tables import SCHEMAS, columns_of

Tables = Mapping[str, DataFrame]

KEYS = {table: [key] for table, key in quality.PRIMARY_KEYS.items()} | {"repayments": quality.SCHEDULE_KEY}
#: Bits of a sketch per key of its load; sketches of a load have a power of two of bits.
BITS_PER_KEY = 16
#: Bits of one bitmap, as Spark's functions lay them out.
BITMAP = 4096 * 8
CELLS = "load int, checked string, total long, kind string, name string, found long, low double, high double"


def _bound(column: str, kind: str, of) -> Column:
    """Numbers as they are and dates as days since 1970; other kinds have no bounds."""
    if kind == "string":
        return F.lit(None).cast("double")
    return of(F.unix_date(column) if kind == "date" else F.col(column)).cast("double")


def _cells(rows: DataFrame, table: str, load: int) -> DataFrame:
    """``load, checked, total, kind, name, found, low, high``: one row per measure, from one scan."""
    kinds = dict(columns_of(table))
    measures = [(quality.NULLS, c, f"{c} IS NULL") for c in quality.NULL_CHECKED.get(table, [])]
    if table in quality.PRIMARY_KEYS:
        measures.append((quality.KEYS, quality.PRIMARY_KEYS[table], f"{quality.PRIMARY_KEYS[table]} IS NOT NULL"))
    if table == "disbursements":
        measures.append((quality.OUTLIERS, "principal", f"principal <= 0 OR principal > {quality.MAX_PRINCIPAL}"))
    found = [
        F.struct(
            F.lit(kind).alias("kind"), F.lit(name).alias("name"), F.count_if(F.expr(test)).alias("found"),
            _bound(name, kinds[name], F.min).alias("low"), _bound(name, kinds[name], F.max).alias("high"),
        )
        for kind, name, test in measures
    ]
    counted = rows.agg(F.count(F.lit(1)).alias("total"), F.array(*found).alias("cells"))
    return counted.select(F.lit(load).alias("load"), F.lit(table).alias("checked"), "total", F.inline("cells"))


def _hash(keys: list[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys])


def _bit(width: Column) -> Column:
    """The place of a key's bit, from 1, as Spark numbers the bits of bitmaps."""
    return F.pmod(F.col("hash"), width) + 1


def _sketch(fresh: DataFrame, number: int) -> DataFrame:
    """``width, bucket, bits``: a bit for each of ``number`` keys."""
    width = max(BITMAP, 1 << (max(1, number) * BITS_PER_KEY - 1).bit_length())
    bit = _bit(F.lit(width))
    placed = fresh.select(F.bitmap_bucket_number(bit).alias("bucket"), F.bitmap_bit_position(bit).alias("place"))
    # places move, not bitmaps: keys of a task are spread over nearly all buckets
    bits = placed.repartition("bucket").groupBy("bucket").agg(F.bitmap_construct_agg("place").alias("bits"))
    return bits.select(F.lit(width).cast("long").alias("width"), "bucket", "bits")


def suspected(found: DataFrame, sketches: DataFrame) -> DataFrame:
    """The rows of ``found`` whose ``hash`` has its bit set in a sketch: all that were there before, and a few more.

    Sketches of equal width are added up first, so a key is looked up once per width.
    """
    widths = [r["width"] for r in sketches.select("width").distinct().collect()]
    if not widths:
        return found.where(F.lit(False))
    added = sketches.groupBy("width", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    asked = found.withColumn("width", F.explode(F.array(*[F.lit(w).cast("long") for w in widths])))
    asked = asked.withColumns({"bucket": F.bitmap_bucket_number(_bit(F.col("width"))), "place": F.bitmap_bit_position(_bit(F.col("width")))})
    byte = F.conv(F.hex(F.expr("substring(bits, CAST(place DIV 8 AS INT) + 1, 1)")), 16, 10).cast("int")
    hit = asked.join(added, ["width", "bucket"]).where(F.getbit(byte, (F.col("place") % 8).cast("int")) == 1)
    return hit.dropDuplicates(["hash", *[c for c in found.columns if c not in ("hash", "n")]]).select(*found.columns)


def _same(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys], F.col("a.hash") == F.col("b.hash"))


def append(spark: SparkSession, t: Tables, folder: str) -> None:
    """Profile new rows of any of the lending tables and add them to the profiles at ``folder``.

    Tables can come in any order and split in any way. A load that stops before its end leaves the
    profiles as they were. Missing values and repeated rows are counted, not left out. A table without
    rows is profiled with no rows; one that no load has brought has no rows in the report.
    """
    before, version = snapshots.current(spark, folder) or {}, snapshots.new_version()
    made = {name: list(paths) for name, paths in before.items() if not name.startswith("waiting")}

    def written(df: DataFrame, name: str) -> DataFrame:
        path = f"{folder}/versions/{version}/{name}.parquet"
        df.write.parquet(path)
        made.setdefault(name, []).append(path)
        return spark.read.schema(df.schema).parquet(path)

    load = len(before.get("cells", [])) + 1
    cells = reduce(DataFrame.unionByName, [_cells(t[table], table, load) for table in SCHEMAS if table in t])
    with ThreadPoolExecutor(AT_ONCE) as threads:  # tables side by side; each still uses the whole cluster
        counting = [threads.submit(written, cells, "cells")]
        if "loan_applications" in t:
            counting.append(threads.submit(written, quality.approvals_by_month(t["loan_applications"]), "months"))
        keeping = [threads.submit(_new_keys, spark, t[table], table, keys, before, written) for table, keys in KEYS.items() if table in t]
        numbers = [done.result() for done in keeping]
        if numbers:
            counting.append(threads.submit(written, spark.createDataFrame(numbers, "checked string, fresh long, repeated long"), "numbers"))
        counting += [threads.submit(_waiting, spark, t, child, before, dict(made), written) for child in quality.REFERENCES]
        for done in counting:
            done.result()
    snapshots.publish(spark, folder, version, made)


def _new_keys(spark: SparkSession, rows: DataFrame, table: str, keys: list[str], before: Mapping, written) -> tuple[str, int, int]:
    """Keep the keys that are new; ``table``, how many, and how many keys are repeated now that were not before.

    A key is kept with ``n``, 1 or 2 for more; one that is met again is kept again with 2.
    """
    if len(keys) == 1:  # a missing primary key is no key; a schedule key with missing parts is one
        rows = rows.where(F.col(keys[0]).isNotNull())
    counted = rows.groupBy(*keys).agg(F.least(F.count(F.lit(1)), F.lit(2)).cast("int").alias("n")).withColumn("hash", _hash(keys))
    old = before.get(f"keys {table}")
    if old is None:
        kept = written(counted.withColumn("fresh", F.lit(True)), f"keys {table}")
    else:
        counted = written(counted, f"waiting keys {table}")  # read twice; later loads do not need it
        maybe = suspected(counted, spark.read.parquet(*before[f"bits {table}"]))
        earlier = spark.read.parquet(*old)
        known = earlier.alias("a").join(maybe.alias("b"), _same(keys), "left_semi").groupBy(*keys, "hash").agg(F.max("n").alias("had"))
        joined = counted.alias("a").join(known.alias("b"), _same(keys), "left").select("a.*", "had")
        changed = joined.where("had IS NULL OR had = 1").withColumn("fresh", F.col("had").isNull())
        kept = written(changed.withColumn("n", F.when(F.col("fresh"), F.col("n")).otherwise(2)).drop("had"), f"keys {table}")
    fresh, repeated = kept.agg(F.count_if("fresh"), F.count_if(F.col("n") > 1)).first()
    written(_sketch(kept.where("fresh"), fresh), f"bits {table}")
    return table, fresh, repeated


def _waiting(spark: SparkSession, t: Tables, child: str, before: Mapping, made: Mapping, written) -> None:
    """Rows without the row they refer to, as ``key, n``; what waited meets the new keys only, new rows meet all."""
    parent, key, _ = quality.REFERENCES[child]
    parts = []
    if f"waiting {child}" in before:
        parts.append((spark.read.parquet(*before[f"waiting {child}"]), made[f"keys {parent}"][-1:] if parent in t else []))
    if child in t:
        parts.append((t[child].groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n")), made.get(f"keys {parent}", [])))
    left = [
        rows.join(spark.read.parquet(*paths).select(F.col(key).alias("key")), "key", "left_anti") if paths else rows
        for rows, paths in parts
    ]
    if left:
        written(reduce(DataFrame.unionByName, left).groupBy("key").agg(F.sum("n").alias("n")), f"waiting {child}")


def _known(spark: SparkSession, folder: str) -> Mapping[str, list[str]]:
    found = snapshots.current(spark, folder)
    if found is None:
        raise ValueError(f"no complete profiles at {folder}")
    return found


def report(spark: SparkSession, folder: str) -> DataFrame:
    """The data-quality report over all loads, from their profiles alone: no table and no key is read."""
    found = _known(spark, folder)
    missing = [name for name in ("cells", "numbers", "months", *[f"waiting {child}" for child in quality.REFERENCES]) if name not in found]
    if missing:
        raise ValueError(f"no load has had the tables behind {missing}")
    read = lambda name: spark.read.parquet(*found[name])
    numbers = read("numbers").groupBy("checked").agg(F.sum("fresh").alias("fresh"), F.sum("repeated").alias("repeated"))
    counts = read("cells").groupBy("checked", "kind", "name").agg(F.sum("total").alias("total"), F.sum("found").alias("found"))
    rows = counts.join(F.broadcast(numbers), "checked", "left")  # a row per table
    surplus = F.when(F.col("kind") == quality.KEYS, F.col("total") - F.coalesce("fresh", F.lit(0))).otherwise(F.col("found"))
    counts = rows.select("checked", "total", "kind", "name", surplus.alias("found"))
    repeated = numbers.where("checked = 'repayments'").agg(F.coalesce(F.sum("repeated"), F.lit(0)).alias("repeated"))
    orphans = {child: read(f"waiting {child}").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("orphans")) for child in quality.REFERENCES}
    months = read("months").groupBy("month").agg(F.sum("approved").alias("approved"), F.sum("total").alias("total"))
    return quality.report_of(counts, repeated, orphans, months)


def history(spark: SparkSession, folder: str) -> DataFrame:
    """``load, table_name, column_name, rows, nulls, low, high``: what each load brought, per checked column.

    Bounds are of numbers, and of dates as days since 1970; texts have none.
    """
    cells = spark.read.schema(CELLS).parquet(*_known(spark, folder)["cells"]).where(F.col("kind") == quality.NULLS)
    return cells.select(
        "load", F.col("checked").alias("table_name"), F.col("name").alias("column_name"), F.col("total").alias("rows"),
        F.col("found").alias("nulls"), "low", "high",
    )
