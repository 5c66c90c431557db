"""Steps between neighbouring rows of ordered groups of any size, without one task per group."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PARTS = "came int, went int, n long, edge struct<part:int,first_key:string,first:int,last_key:string,last:int>"


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``key, state`` in order to counts of steps inside the partition, and its first and last row."""
    counts: dict[tuple[int, int], int] = {}
    first = last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key, state = batch.column(0), batch.column(1).to_numpy()
        if first is None:
            first = (key[0].as_py(), int(state[0]))
        if last is not None and last[0] == key[0].as_py():
            step = (last[1], int(state[0]))
            counts[step] = counts.get(step, 0) + 1
        same = pa.compute.equal(key.slice(0, len(key) - 1), key.slice(1)).to_numpy(zero_copy_only=False).astype(bool)
        pairs, times = np.unique(np.stack([state[:-1][same], state[1:][same]]), axis=1, return_counts=True)
        for came, went, n in zip(*pairs.tolist(), times.tolist(), strict=True):
            counts[came, went] = counts.get((came, went), 0) + n
        last = (key[-1].as_py(), int(state[-1]))
    if first is not None:
        edge = {"part": TaskContext.get().partitionId(), "first_key": first[0], "first": first[1], "last_key": last[0], "last": last[1]}
        rows = [(came, went, n, None) for (came, went), n in counts.items()] + [(None, None, None, edge)]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.struct([("part", pa.int32()), ("first_key", pa.string()), ("first", pa.int32()), ("last_key", pa.string()), ("last", pa.int32())])]
        columns = [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, names=["came", "went", "n", "edge"])


def steps(rows: DataFrame, key: str, state: str, order: Sequence[str]) -> DataFrame:
    """``came, went, n``: how often a group's row in state ``came`` is followed by one in state ``went``.

    ``key`` is a string and names the group, ``state`` a small whole number; rows without either are
    left out. Rows are cut into sorted ranges, so a group of any size is shared by many tasks. Each
    task counts the steps inside its range; the step from a range to the next is told by the ranges'
    first and last rows, one pair per task. Rows equal in ``key`` and ``order`` come in any order.
    """
    known = rows.where(F.col(key).isNotNull() & F.col(state).isNotNull())
    narrow = known.select(F.col(key).cast("string").alias("key"), F.col(state).cast("int").alias("state"), *[F.col(c).alias(f"by_{i}") for i, c in enumerate(order)])
    keys = ["key", *[f"by_{i}" for i in range(len(order))], "state", "place"]
    dealt = narrow.withColumn("place", F.monotonically_increasing_id()).repartitionByRange(*keys)
    parts = dealt.sortWithinPartitions(*keys).select("key", "state").mapInArrow(_steps, PARTS)
    counted = parts.groupBy("came", "went").agg(F.sum("n").alias("n"), F.sort_array(F.collect_list("edge")).alias("edges"))
    following = F.transform(F.slice("edges", F.lit(2), F.greatest(F.size("edges") - 1, F.lit(0))), lambda e, i: F.struct(F.get("edges", i).alias("a"), e.alias("b")))
    crossed = F.transform(
        F.filter(following, lambda x: x["a"]["last_key"] == x["b"]["first_key"]),
        lambda x: F.struct(x["a"]["last"].alias("came"), x["b"]["first"].alias("went"), F.lit(1).cast("long").alias("n")),
    )
    inside = F.array(F.struct("came", "went", "n"))
    every = counted.select(F.inline(F.when(F.col("came").isNull(), crossed).otherwise(inside)))
    return every.groupBy("came", "went").agg(F.sum("n").alias("n"))
