"""Near-duplicate vectors: spherical k-means cells, and blocked cosine products inside them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlens.llm.components import components
from loanlens.llm.simhash import _forest
from loanlens.session import stored

COSINE = 0.9
#: Different vectors per cell aimed at, most cells, and sampled vectors per cell for the fit.
PER_CELL, MOST_CELLS, SAMPLED_PER_CELL = 512, 4096, 16
ROUNDS = 8
#: Vectors on either side of one product.
BLOCK = 1024
#: Vectors, and numbers in them, on either side of a task's work: how often a vector is sent, not what is compared.
SIDE, SIDE_NUMBERS = 8192, 1 << 21


def unit_rows(vectors: pd.Series, width: int) -> np.ndarray:
    """The vectors as rows of length one in double precision; missing components are zero."""
    rows = np.zeros((len(vectors), width))
    for row, vector in zip(rows, vectors, strict=True):
        row[: len(vector)] = vector
    largest = np.abs(rows).max(axis=1, initial=0, keepdims=True)
    rows /= np.where(largest > 0, largest, 1)  # so that no square overflows or vanishes
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(norms > 0, norms, 1)


def spherical_kmeans(sample: np.ndarray, cells: int, rounds: int = ROUNDS) -> np.ndarray:
    """Unit centres of ``cells`` cells; a cell that loses all its vectors keeps its centre."""
    random = np.random.default_rng(3)
    centres = sample[np.sort(random.choice(len(sample), cells, replace=False))].copy()
    for _ in range(rounds):
        nearest = np.concatenate([np.argmax(sample[at : at + 8192] @ centres.T, axis=1) for at in range(0, len(sample), 8192)])
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, sample)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norms > 0, sums / np.where(norms > 0, norms, 1), centres)
    return centres


def usable(vectors: DataFrame, vector_column: str) -> F.Column:
    """Not null or empty, all components there and finite, and not all zero."""
    each = F.col(vector_column)
    finite = F.forall(each, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(each, lambda x: x != 0), F.lit(False))


def near_duplicates(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", least: float = COSINE
) -> DataFrame:
    """``id, n_links, component_id, kept`` for every row.

    Equal vectors are one node with its number of rows. Every pair with a cosine of ``least`` or
    more in double precision is a link. Cells come from a fit on a sample of SAMPLED_PER_CELL
    vectors for each of at most MOST_CELLS cells, drawn by a digest of the vector, and only spare
    comparisons: a vector is in the cell of its nearest centre, and meets those of every cell that
    a vector within ``least`` of it can be in (``_reach``). Vectors without clusters reach all
    cells, so that every pair is compared.

    Cells are put together to groups, groups of any size are cut into blocks, and each pair of
    blocks is a task's work: its product adds to the counts and leaves a spanning set of its links. Vectors that are null, empty, zero
    or not finite link with nothing and stand for themselves. Vectors of other widths are taken as
    ending in zeros. Null ids are counted as links but are no component. Repeated rows count as often
    as they occur. Other columns are not read, so none can clash. No rows, no result.
    """
    rows = vectors.select(F.col(id_column).alias("id"), F.col(vector_column).cast("array<double>").alias("vector"))
    good = rows.where(usable(rows, "vector"))
    # -0.0 and 0.0 are one value here
    plain = good.select("id", F.transform("vector", lambda x: x + F.lit(0.0)).alias("vector"))
    nodes = stored(
        plain.groupBy("vector").agg(F.min("id").alias("smallest"), F.count(F.lit(1)).alias("copies")).select(
            F.xxhash64("vector").alias("digest"), "vector", "smallest", "copies"
        ),
        "nodes",
    )
    numbered = stored(nodes.withColumn("node", F.monotonically_increasing_id()), "numbered")
    size = numbered.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    if not size[0]:
        return rows.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    found = stored(_links(numbered, size[0], size[1], least), "cell-links")
    counts = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    joined = components(found.where("b is not null").select("a", "b"))
    placed = (
        numbered.select("node", "vector", "smallest", "copies")
        .join(counts, "node", "left")
        .join(joined, "node", "left")
        .select("vector", "smallest", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "node").alias("root"))
    )
    placed = stored(placed, "placed")
    named = placed.groupBy("root").agg(F.min("smallest").alias("component_id"))
    told = placed.join(named, "root").select("vector", "n_links", "component_id")
    linked = plain.join(told, "vector").select("id", "n_links", "component_id")
    alone = rows.where(~usable(rows, "vector")).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))


def _links(nodes: DataFrame, number: int, width: int, least: float) -> DataFrame:
    """Rows ``a, b, n``: a link for the components, or (``b`` null) ``n`` linked rows of node ``a``."""
    context = nodes.sparkSession.sparkContext
    cells = min(MOST_CELLS, max(1, number // PER_CELL))
    sample = nodes.orderBy("digest", "smallest").select("vector").limit(SAMPLED_PER_CELL * cells).toPandas()["vector"]
    centres = context.broadcast(spherical_kmeans(unit_rows(sample, width), min(cells, len(sample))))

    side = max(BLOCK, min(SIDE, SIDE_NUMBERS // max(1, width)))
    together = max(1, side // PER_CELL)

    def assign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), BLOCK):
                part = frame.iloc[at : at + BLOCK]
                home, reached = _reach(unit_rows(part["vector"], width), centres.value, least)
                groups = [np.unique(np.flatnonzero(r) // together).astype(np.int32) for r in reached]
                yield part.assign(home=(home // together).astype(np.int32), groups=groups)

    schema = "node long, vector array<double>, copies long, home int, groups array<int>"
    assigned = stored(nodes.select("node", "vector", "copies").mapInPandas(assign, schema), "assigned")
    sizes = assigned.groupBy("home").agg(F.ceil(F.count(F.lit(1)) / side).alias("blocks"))
    own = assigned.join(F.broadcast(sizes), "home").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks"))).drop("blocks")
    met = own.withColumn("group", F.explode("groups")).join(F.broadcast(sizes.withColumnRenamed("home", "group")), "group")
    # a vector meets all blocks of a group that it reaches
    paired = met.withColumn("other_block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    mine, other = F.struct(F.col("home").alias("group"), "block"), F.struct("group", F.col("other_block").alias("block"))
    sided = paired.withColumn("mine", mine).withColumn("other", other).withColumn("low", F.least("mine", "other")).withColumn("high", F.greatest("mine", "other"))
    placed = sided.select(
        "node", "vector", "copies", (F.col("mine") == F.col("low")).alias("is_low"), (F.col("mine") == F.col("high")).alias("is_high"),
        F.col("low.group").alias("low_group"), F.col("low.block").alias("low_block"), F.col("high.group").alias("high_group"), F.col("high.block").alias("high_block"),
    )

    def product(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("node")
        left, right = frame[frame["is_low"]], frame[frame["is_high"]]
        a, b = _linked(unit_rows(left["vector"], width), unit_rows(right["vector"], width), least, key[:2] == key[2:])
        nodes_, copies = frame["node"].to_numpy(), frame["copies"].to_numpy()
        at_a = np.searchsorted(nodes_, left["node"].to_numpy())[a]
        at_b = np.searchsorted(nodes_, right["node"].to_numpy())[b]
        n = np.bincount(at_a, copies[at_b], len(nodes_)) + np.bincount(at_b, copies[at_a], len(nodes_))
        counted = np.flatnonzero(n)
        label = _forest(len(nodes_), at_a, at_b)
        joined = np.flatnonzero(label != np.arange(len(nodes_)))
        return pd.DataFrame(
            {
                "a": np.concatenate([nodes_[counted], nodes_[joined]]),
                "b": pd.array([None] * len(counted) + nodes_[label[joined]].tolist(), dtype="Int64"),
                "n": np.concatenate([n[counted], np.zeros(len(joined))]).astype(np.int64),
            }
        )

    return placed.groupBy("low_group", "low_block", "high_group", "high_block").applyInPandas(product, "a long, b long, n long")


def _reach(rows: np.ndarray, centres: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of each row, and the centres that may be the nearest of a row within ``least`` of it.

    Let h be the nearest centre of x, and c that of y. Then y(h - c) <= 0, so x(h - c) is at most
    |x - y| |h - c|, and a cosine of ``least`` is a distance |x - y| of sqrt(2 - 2 least).
    """
    nearness = rows @ centres.T
    home = nearness.argmax(axis=1)
    apart = np.sqrt(np.maximum(2 - 2 * (centres @ centres.T), 0))
    short = nearness[np.arange(len(rows)), home][:, None] - nearness
    return home, short <= np.sqrt(2 - 2 * least) * apart[home] + 1e-6  # more than rounding can take


def _linked(left: np.ndarray, right: np.ndarray, least: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Positions of linked pairs, each pair once."""
    found_a, found_b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for low in range(0, len(left), BLOCK):
        for high in range(low if same else 0, len(right), BLOCK):
            near = left[low : low + BLOCK] @ right[high : high + BLOCK].T >= least
            a, b = np.nonzero(np.triu(near, 1) if same and low == high else near)
            found_a.append(a + low)
            found_b.append(b + high)
    return np.concatenate(found_a), np.concatenate(found_b)
