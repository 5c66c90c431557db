"""SimHash near-duplicates by meeting in the middle of two Hamming balls.

Every fingerprint stands for all variants of it within half the radius. Two fingerprints are
within the radius exactly if they share a variant, so fingerprints that meet in one variant are
linked and nothing else is compared.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlens.llm.common import ROW, carried, unpacked
from loanlens.llm.components import components
from loanlens.session import stored

SHINGLE_WORDS = 4
SEED = 42
RADIUS = 4
#: Shingles turned into bits at a time; bounds memory for very long texts.
SHINGLES_AT_ONCE = 1 << 15
#: Variants compared at a time in a task.
VARIANTS_AT_ONCE = 1 << 21
#: Up to so many row numbers are sent to all executors; a hash table of them has some 50 MB.
BROADCAST_ROWS = 1 << 21


def simhash(text: str | None, words_each: int = SHINGLE_WORDS) -> int:
    """The 64-bit fingerprint of one text, unsigned; zero if it has no words."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()  # both look at ASCII letters and blanks only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = (ends - np.fromiter(map(len, words), np.int64, len(words)) - 1).tolist()
    number = max(1, len(words) - words_each + 1)
    stops = (ends[-number:] - 1).tolist()
    ones = np.zeros(64, np.int64)
    for at in range(0, number, SHINGLES_AT_ONCE):
        spans = zip(starts[at : min(at + SHINGLES_AT_ONCE, number)], stops[at : at + SHINGLES_AT_ONCE], strict=True)
        hashes = np.array([xxh64_intdigest(joined[s:e], SEED) for s, e in spans], dtype=">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > number).tobytes(), "big")


@F.pandas_udf(T.LongType())
def fingerprint(texts: pd.Series) -> pd.Series:
    """``simhash`` of each text, as a signed long with the same bits."""
    return pd.Series(np.array([simhash(t) for t in texts], dtype=np.uint64).view(np.int64))


def _masks(bits: int, flips: int) -> np.ndarray:
    """All masks over ``bits`` bits with at most ``flips`` of them set."""
    sets = (c for n in range(flips + 1) for c in combinations(range(bits), n))
    return np.array([sum(1 << b for b in c) for c in sets], dtype=np.uint64)


def _local_links(prefix_bits: int, half: int, radius: int):
    """A task's part of the meeting: rows ``prefix, fp`` sorted by prefix to links ``a, b``."""
    suffix = 64 - prefix_bits

    def variants(prefix: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        flipped = np.bitwise_count(prefix ^ (fp >> np.uint64(suffix)))
        base = (prefix << np.uint64(suffix)) | (fp & np.uint64((1 << suffix) - 1))
        made, owner = [], []
        for used in range(half + 1):
            here = np.flatnonzero(flipped == used)
            masks = _masks(suffix, half - used)
            made.append((base[here, None] ^ masks[None, :]).ravel())
            owner.append(np.repeat(here, len(masks)))
        return np.concatenate(made), np.concatenate(owner)

    def links(prefix: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        made, owner = variants(prefix, fp)
        order = np.argsort(made, kind="stable")
        made, owner = made[order], owner[order]
        same = np.flatnonzero(made[1:] == made[:-1])
        pairs = np.unique(owner[same] * np.int64(len(fp)) + owner[same + 1])
        a, b = pairs // len(fp), pairs % len(fp)
        near = np.bitwise_count(fp[a] ^ fp[b]) <= radius
        label = _forest(len(fp), a[near], b[near])
        linked = np.flatnonzero(label != np.arange(len(fp)))
        return pa.RecordBatch.from_arrays(
            [pa.array(fp[linked].view(np.int64)), pa.array(fp[label[linked]].view(np.int64))], names=["a", "b"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prefix, fp, weight = np.empty(0, np.uint64), np.empty(0, np.uint64), 0
        for batch in batches:
            prefix = np.concatenate([prefix, batch.column(0).to_numpy().astype(np.uint64)])
            fp = np.concatenate([fp, batch.column(1).to_numpy().view(np.uint64)])
            weight += 16 * batch.num_rows
            if weight >= VARIANTS_AT_ONCE and prefix[0] != prefix[-1]:  # the last prefix may go on
                whole = int(np.searchsorted(prefix, prefix[-1]))
                yield links(prefix[:whole], fp[:whole])
                prefix, fp = prefix[whole:], fp[whole:]
                weight = 16 * len(fp)
        if len(fp):
            yield links(prefix, fp)

    return run


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index linked with each of ``n``, directly or not."""
    label = np.arange(n)
    while len(a):
        least = np.minimum(label[a], label[b])
        after = label.copy()
        np.minimum.at(after, a, least)
        np.minimum.at(after, b, least)
        after = after[after]
        if np.array_equal(after, label):
            break
        label = after
    return label


def links(fingerprints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links ``a, b`` that join exactly the fingerprints (``fp``, distinct, not null) within ``radius``.

    A spanning set, not all pairs: fingerprints within the radius are joined by a path of links,
    and every link lies on a path of pairs within the radius. ``radius`` must be even: then
    meeting in a variant is the same as being near.

    The shuffle key is the leading part of a variant; what the rest can be is spelled out inside
    the task. So a fingerprint is sent some hundred times rather than 2,081 times (radius 4). The
    part's width follows the number of fingerprints, which keeps the rows of one key few at any
    size; it decides the layout and not the links.
    """
    if radius % 2:
        raise ValueError("the radius must be even")
    half = radius // 2
    prefix_bits = min(48, max(12, math.ceil(math.log2(fingerprints.count() + 1)) - 4))
    masks = F.array(*[F.lit(int(m)) for m in _masks(prefix_bits, half)])
    leading = F.shiftrightunsigned("fp", 64 - prefix_bits)
    spread = fingerprints.select("fp", F.explode(masks).alias("mask")).select(leading.bitwiseXOR(F.col("mask")).alias("prefix"), "fp")
    met = spread.repartition("prefix").sortWithinPartitions("prefix")
    return met.mapInArrow(_local_links(prefix_bits, half, radius), "a long, b long")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", radius: int = RADIUS) -> DataFrame:
    """Add ``fp`` (long) and ``component_id``: the smallest id among the documents linked with this one, itself included.

    Null and empty texts and such without words have fingerprint zero and are near-duplicates of
    each other. Null ids take part but are nobody's component unless all of the group's are null.
    Repeated rows stay. Columns of the input named like the added ones are replaced. Equal
    fingerprints are one node, so a group of copies of any size is one row in the search.
    """
    marked = carried(docs).withColumn("fp", fingerprint(F.col(f"{ROW}.`{text_column}`")))
    narrow = stored(marked.select(F.col(f"{ROW}.`{id_column}`").alias("id"), "fp"), "fingerprints")
    return unpacked(marked.join(_classes(narrow, radius), "fp"), docs.columns, "fp", "component_id")


def _classes(ids: DataFrame, radius: int) -> DataFrame:
    """``fp, root, component_id`` of every fingerprint among the written rows ``id, fp``."""
    nodes = stored(ids.groupBy("fp").agg(F.min("id").alias("smallest")), "nodes")
    found = components(links(nodes.select("fp"), radius))
    placed = nodes.join(found, nodes.fp == found.node, "left").select(
        "fp", "smallest", F.coalesce("component", "fp").alias("root")
    )
    named = placed.groupBy("root").agg(F.min("smallest").alias("component_id"))
    return stored(placed.join(named, "root").select("fp", "root", "component_id"), "classes")


def with_classes(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id_column, fp, component_id`` without the texts, which are read once."""
    narrow = stored(docs.select(F.col(id_column).alias("id"), fingerprint(text_column).alias("fp")), "fingerprints")
    return narrow.join(_classes(narrow, RADIUS), "fp").select(F.col("id").alias(id_column), "fp", "component_id")


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id.

    Rows with an id come before rows without. Of several rows with that id it is the one whose
    other columns have the smallest digest, so that reruns agree. Columns as in ``docs``; none can
    clash. No rows, none kept.

    Groups are told on numbers alone. The rows are written once with their numbers, and those that
    go are taken out where they lie: their numbers are sent to all executors up to BROADCAST_ROWS,
    and joined beyond that.
    """
    row = lambda name: F.col(f"{ROW}.`{name}`")
    marked = carried(docs).select(
        ROW, fingerprint(row(text_column)).alias("fp"), F.xxhash64(ROW).alias("digest"), F.monotonically_increasing_id().alias("number")
    )
    marked = stored(marked, "marked")
    narrow = stored(marked.select(row(id_column).alias("id"), "fp", "digest", "number"), "narrow")
    classes = _classes(narrow.select("id", "fp"), RADIUS).select("fp", "root")
    members = narrow.join(classes, "fp").select("root", "number", F.struct(F.col("id").isNull().alias("last"), "id", "digest", "number").alias("place"))
    several = members.groupBy("root").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("rows")).where("rows > 1")
    gone = stored(members.join(several, "root").where(F.col("number") != F.col("first.number")).select("number"), "gone")
    left_out = F.broadcast(gone) if gone.count() <= BROADCAST_ROWS else gone
    return unpacked(marked.join(left_out, "number", "left_anti"), docs.columns)
