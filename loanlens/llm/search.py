"""Exact BM25 top-k over an inverted index in shards, with block-max WAND in each."""

from __future__ import annotations

import heapq
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanlens.session import stored

K1, B = 1.2, 0.75
TOP = 10
#: Documents per shard and postings per block.
SHARD, BLOCK = 4096, 64
#: Scores are compared after rounding to so many decimals; equal ones go by document.
DECIMALS = 6
TERM = re.compile(rb"[a-z0-9\x80-\xff]+")


def terms(text: str | None) -> list[bytes]:
    """Runs of letters A-Z (lowered), digits and characters beyond ASCII."""
    return TERM.findall((text or "").encode().lower())


INDEX = "shard long, term string, block int, docs array<int>, freqs array<int>, lengths array<int>, most int, shortest int"


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    first, number = TaskContext.get().partitionId() << 32, 0
    ids: list = []
    texts: list = []
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            ids += part.column(0).to_pylist()
            texts += [_counted(t) for t in part.column(1).to_pylist()]
            if len(ids) >= SHARD:
                yield from _shard(first + number, ids, texts)
                ids, texts, number = [], [], number + 1
    if ids:
        yield from _shard(first + number, ids, texts)


def _counted(text: str | None) -> tuple[int, Counter]:
    found = terms(text)
    return len(found), Counter(found)


def _shard(shard: int, ids: list, texts: list[tuple[int, Counter]]) -> Iterator[pa.RecordBatch]:
    """Blocks of one shard; a row without a term lists the shard's documents and their lengths."""
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))
    postings: dict[bytes, tuple[list[int], list[int]]] = {}
    for place, i in enumerate(order):
        for term, freq in texts[i][1].items():
            docs, freqs = postings.setdefault(term, ([], []))
            docs.append(place)
            freqs.append(freq)
    lengths = np.array([texts[i][0] for i in order], np.int32)
    rows: dict[str, list] = {name.split()[0]: [] for name in INDEX.split(", ")} | {"ids": []}

    def add(*values):
        for column, value in zip(rows.values(), values, strict=True):
            column.append(value)

    add(shard, None, 0, None, None, lengths, 0, 0, [ids[i] for i in order])
    for term, (docs, freqs) in postings.items():
        for block, at in enumerate(range(0, len(docs), BLOCK)):
            some, often = docs[at : at + BLOCK], freqs[at : at + BLOCK]
            sizes = lengths[some]
            add(shard, term.decode(), block, some, often, sizes, max(often), int(sizes.min()), None)
            if len(rows["shard"]) >= 20_000:
                yield _rows(rows)
                rows = {name: [] for name in rows}
    yield _rows(rows)


def _rows(rows: dict[str, list]) -> pa.RecordBatch:
    ints = pa.list_(pa.int32())
    kinds = [pa.int64(), pa.string(), pa.int32(), ints, ints, ints, pa.int32(), pa.int32(), pa.list_(pa.int64())]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows.values(), kinds, strict=True)], names=list(rows))


def build_index(docs: DataFrame) -> DataFrame:
    """The index of ``doc_id, text`` rows, written to the shared folder; texts are read once, whole.

    Shards are made where the rows are read, without a shuffle. Per shard and term it holds blocks
    of postings in document order (place in the shard, frequency, length), each with the bounds its
    best score follows from for any collection: the highest frequency and the shortest length.
    """
    return stored(docs.select("doc_id", "text").mapInArrow(_index, INDEX + ", ids array<long>"), "bm25-index")


class Cursor:
    """A position in one term's postings, with the term's best score overall and per block."""

    __slots__ = ("best", "bounds", "doc", "docs", "ends", "gains", "place")

    def __init__(self, docs: list[int], gains: list[float], bounds: list[float], ends: list[int]):
        self.docs, self.gains, self.bounds, self.ends = docs, gains, bounds, ends
        self.best, self.place, self.doc = max(bounds), 0, docs[0]

    def seek(self, doc: int) -> None:
        self.place = bisect_left(self.docs, doc, self.place)
        self.doc = self.docs[self.place] if self.place < len(self.docs) else END

    def block(self, doc: int) -> tuple[float, int]:
        """Bound and last document of the block where ``doc`` would be."""
        at = bisect_left(self.ends, doc)
        return (self.bounds[at], self.ends[at]) if at < len(self.ends) else (0.0, END)


END = 1 << 60


def wand(cursors: list[Cursor], top: int) -> list[tuple[float, int]]:
    """The best ``top`` documents as (score, document); equal scores go to the smaller document.

    Documents come in order, so a later one must beat the worst kept score to enter; what cannot,
    by the terms' best scores or those of their blocks, is skipped unread.
    """
    cursors = list(cursors)
    kept: list[tuple[float, int]] = []
    slack = 10.0**-DECIMALS
    while True:
        cursors = sorted((c for c in cursors if c.doc < END), key=lambda c: c.doc)
        least = kept[0][0] - slack if len(kept) == top else -1.0
        bound, pivot = 0.0, None
        for at, cursor in enumerate(cursors):
            bound += cursor.best
            if bound > least:
                pivot = at
                break
        if pivot is None:
            return sorted(((s, -d) for s, d in kept), key=lambda r: (-r[0], r[1]))
        doc = cursors[pivot].doc
        while pivot + 1 < len(cursors) and cursors[pivot + 1].doc == doc:
            pivot += 1
        blocks = [c.block(doc) for c in cursors[: pivot + 1]]
        if sum(b for b, _ in blocks) <= least:
            after = min(e for _, e in blocks) + 1
            if pivot + 1 < len(cursors):
                after = min(after, cursors[pivot + 1].doc)
            for cursor in cursors[: pivot + 1]:
                if cursor.doc < after:
                    cursor.seek(after)
            continue
        score = 0.0
        for cursor in cursors[: pivot + 1]:
            if cursor.doc < doc:
                cursor.seek(doc)
            if cursor.doc == doc:
                score += cursor.gains[cursor.place]
                cursor.seek(doc + 1)
        entry = (round(score, DECIMALS), -doc)
        if len(kept) < top:
            heapq.heappush(kept, entry)
        elif entry > kept[0]:
            heapq.heapreplace(kept, entry)


def _saturated(freq: np.ndarray, length: np.ndarray, mean: float) -> np.ndarray:
    return freq * (K1 + 1) / (freq + K1 * (1 - B + B * length / mean))


def search(index: DataFrame, queries: DataFrame, id_column: str, text_column: str = "text", top: int = TOP) -> DataFrame:
    """``id_column, rank, doc_id, score``: the ``top`` documents of each query, exactly.

    A document's score is the sum over the query's terms, repeats counted, of idf times saturated
    frequency; documents without any of the terms are no answers. Scores use the counts of the whole
    collection, so the shards' answers merge by sorting. Each query meets each shard in a group of
    its own that holds the postings of the query's terms there, bounded by the shard's size.

    Queries that are null or empty have no answers. Ties go to the smaller ``doc_id``, null last;
    repeated rows are answers of their own. Other columns are not read; an empty index has no answers.
    """
    shards = index.where("term is null")
    size = shards.agg(F.sum(F.size("ids")), F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x))).first()
    number, mean = size[0] or 0, max((size[1] or 0) / max(size[0] or 0, 1), 1e-9)

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (q, t.decode(), n)
                for q, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
                for t, n in Counter(terms(text)).items()
            ]
            columns = zip(*rows, strict=True) if rows else ([], [], [])
            kinds = (batch.schema.types[0], pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["query", "term", "times"])

    kind = queries.schema[id_column].dataType.simpleString()
    words = stored(queries.select(id_column, text_column).mapInArrow(asked, f"query {kind}, term string, times long"), "query-terms")
    met = stored(index.join(words.select("term").distinct(), "term", "left_semi").drop("ids"), "met-postings")
    frequency = met.groupBy("term").agg(F.sum(F.size("docs")).alias("df"))
    idf = F.log(1 + (number - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weighed = words.join(frequency, "term").select("query", "term", (F.col("times") * idf).alias("weight"))

    def answer(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        cursors = []
        for _, rows in frame.sort_values(["term", "block"]).groupby("term", sort=True):
            weight = rows["weight"].iloc[0]
            docs, freqs, lengths = (np.concatenate(rows[c].to_list()) for c in ("docs", "freqs", "lengths"))
            gains = weight * _saturated(freqs, lengths, mean)
            # rounding must not bring a bound below a gain
            bounds = weight * _saturated(rows["most"].to_numpy(), rows["shortest"].to_numpy(), mean) * (1 + 1e-12)
            cursors.append(Cursor(docs.tolist(), gains.tolist(), bounds.tolist(), [int(d[-1]) for d in rows["docs"]]))
        best = wand(cursors, top)
        return pd.DataFrame({"query": [key[0]] * len(best), "shard": key[1], "place": [d for _, d in best], "score": [s for s, _ in best]})

    joined = met.join(weighed, "term")
    found = joined.groupBy("query", "shard").applyInPandas(answer, f"query {kind}, shard long, place int, score double")
    named = found.join(shards.select("shard", "ids"), "shard").select("query", "score", F.col("ids")[F.col("place")].alias("doc_id"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = named.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select(F.col("query").alias(id_column), "rank", "doc_id", "score")
