"""Connected components over tables of links."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlens.session import stored

#: A node with very many links is spread over so many parts before adaptive joins split it further.
SALTS = 8


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links`` (``a, b``, any integer type, no nulls).

    The component is the smallest node that can be reached. Rounds of large-star and small-star
    steps, each a few joins over the links, until nothing changes; each round is written to the
    shared folder, so a lost executor repeats one round at most. Self-links and repeats are
    allowed. No links, no rows.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    edges = stored(links.select(high.alias("hi"), low.alias("lo")).where("hi <> lo").distinct(), "links")
    state = _state(edges)
    while state[0]:
        edges = stored(_small_star(_large_star(edges)), f"links-{uuid.uuid4().hex[:6]}")
        before, state = state, _state(edges)
        if state == before:
            break
    leaves = edges.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
    roots = edges.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    return leaves.unionByName(roots)


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("hi", "lo"))).first())


def _to_smallest(pairs: DataFrame, smallest: DataFrame) -> DataFrame:
    """Join ``u, v`` with ``u, m`` where some ``u`` has very many rows."""
    salted = pairs.withColumn("part", F.pmod(F.hash("v"), F.lit(SALTS)))
    copies = smallest.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(copies, ["u", "part"])


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest neighbour."""
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
        edges.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
    )
    smallest = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return _to_smallest(both.where("v > u"), smallest).select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    smallest = edges.groupBy(F.col("hi").alias("u")).agg(F.min("lo").alias("m"))
    pairs = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v"))
    moved = _to_smallest(pairs, smallest).where("v <> m").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
    return moved.unionByName(smallest.select(F.col("u").alias("hi"), F.col("m").alias("lo"))).distinct()
