"""Documents packed into sequences of fixed length by exact complements, then by best fit.

Only lengths decide a packing, and there are at most as many different ones as tokens in a
sequence. So the plan is made from their counts, and rows only look up their place in it.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlens.llm.common import bucket_of, ranked
from loanlens.llm.encoding import WordEncoder
from loanlens.session import stored

LENGTH = 4096
TEXTS_AT_ONCE = 256

PIECE = "piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer_path: str, with_ids: bool = False, length: int = LENGTH) -> DataFrame:
    """Cut each document (``doc_id, text``) into pieces of at most ``length`` tokens.

    Rows of ``doc_id, piece, start, length, ids_crc32``, and the ids themselves if asked for. A
    null or empty text is one piece of the end id alone. Repeated rows are packed like others.
    Other columns are not read, so none can clash. No rows, no pieces.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = WordEncoder(tokenizer_path).ids
        for batch in (b.slice(at, TEXTS_AT_ONCE) for b in batches for at in range(0, b.num_rows, TEXTS_AT_ONCE)):
            owner, number, starts, sizes, sums, parts = [], [], [], [], [], []
            for row, text in enumerate(batch.column(1).cast(pa.binary()).to_pylist()):
                ids = memoryview(encode(text))
                for piece, at in enumerate(range(0, len(ids), 4 * length)):
                    part = ids[at : at + 4 * length]
                    owner.append(row)
                    number.append(piece)
                    starts.append(at // 4)
                    sizes.append(len(part) // 4)
                    sums.append(zlib.crc32(part))
                    if with_ids:
                        parts.append(np.frombuffer(part, "<i4"))
            columns = [batch.column(0).take(pa.array(owner, pa.int64())), pa.array(number, pa.int32())]
            columns += [pa.array(c, pa.int64()) for c in (starts, sizes, sums)]
            if with_ids:
                columns.append(pa.array(parts, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    kind = docs.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", kind), *T._parse_datatype_string(PIECE).fields])
    if with_ids:
        schema = schema.add("ids", T.ArrayType(T.IntegerType()))
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    return docs.select("doc_id", "text").mapInArrow(run, schema)


class SumIndex:
    """Hash tables from a sum to the single length, the pairs and the triples of lengths that add up to it.

    Pairs are laid out by their sum, the one with the longest first; ``live`` counts those whose
    lengths are still there. A triple sum is indexed by its longest lengths, each of which leaves an
    indexed pair sum. Lengths only run out, so what a table holds is checked against the counts
    when it is asked, and never added to.
    """

    def __init__(self, counts: dict[int, int], size: int):
        self.size = size
        self.count = np.zeros(size + 1, np.int64)
        self.count[list(counts)] = list(counts.values())
        self.lengths = np.flatnonzero(self.count)
        longest = self.lengths[::-1]
        partners = np.minimum(np.arange(len(longest), 0, -1), np.searchsorted(self.lengths, size - longest, "right"))
        first = np.repeat(longest, partners).astype(np.int32)
        ends = np.cumsum(partners)
        second = self.lengths.astype(np.int32)[np.arange(len(first)) - np.repeat(ends - partners, partners)]
        total = first + second
        order = np.argsort(total, kind="stable")  # keeps the longest first
        self.first, self.starts = first[order], np.searchsorted(total[order], np.arange(size + 2))
        there = (first != second) | (self.count[first] > 1)
        self.live = np.bincount(total[there], minlength=size + 1)
        self.triples: dict[int, np.ndarray] = {}

    def take(self, length: int, times: int) -> None:
        before, after = self.count[length], self.count[length] - times
        self.count[length] = after
        if before > 1 >= after and 2 * length <= self.size:
            self.live[2 * length] -= 1
        if before > 0 >= after:
            others = self.lengths[(self.lengths <= self.size - length) & (self.lengths != length)]
            self.live[length + others[self.count[others] > 0]] -= 1

    def single(self, total: int) -> tuple[int, ...] | None:
        return (total,) if 0 < total and self.count[total] > 0 else None

    def pair(self, total: int) -> tuple[int, ...] | None:
        if total < 2 or not self.live[total]:
            return None
        first = self.first[self.starts[total] : self.starts[total + 1]]
        second = total - first
        there = np.flatnonzero((self.count[first] > (first == second)) & (self.count[second] > 0))
        return (int(first[there[0]]), int(second[there[0]])) if len(there) else None

    def triple(self, total: int) -> tuple[int, ...] | None:
        if total < 3:
            return None
        if total not in self.triples:
            longest = self.lengths[self.lengths <= total - 2][::-1]
            rest = total - longest
            self.triples[total] = longest[(self.starts[rest + 1] > self.starts[rest]) & (3 * longest >= total)]
        longest = self.triples[total]
        for length in longest[(self.count[longest] > 0) & (self.live[total - longest] > 0)].tolist():
            self.count[length] -= 1  # while its pair is looked up
            found = self.pair(total - length)
            self.count[length] += 1
            if found:
                return (length, *found)
        return None


class Plan:
    """Patterns of lengths with how often each is used, from the counts of lengths.

    Longest first, each length's gap is looked up among the single, pair and triple sums of what is
    there, and the combination found fills sequences exactly, as often as all of it lasts. What has
    no exact complement is put, longest first, into the fullest open sequence where it fits; equal
    sequences are handled as one with a count, so the work depends on the different lengths and not
    on the rows.
    """

    def __init__(self, counts: dict[int, int], size: int = LENGTH):
        self.size = size
        self.patterns: list[tuple[tuple[int, ...], int]] = []
        rest: list[tuple[int, int]] = []
        index = SumIndex({n: c for n, c in counts.items() if c}, size)
        for n in index.lengths[::-1].tolist():
            while index.count[n]:
                combination = self._complement(index, n)
                if combination is None:
                    rest.append((n, int(index.count[n])))
                    index.take(n, int(index.count[n]))
                else:
                    need = {m: combination.count(m) for m in combination}
                    times = min(int(index.count[m]) // k for m, k in need.items())
                    for m, k in need.items():
                        index.take(m, times * k)
                    self.patterns.append((combination, times))
        self._best_fit(rest)

    def _complement(self, index: SumIndex, n: int) -> tuple[int, ...] | None:
        """``n`` and the one, two or three lengths that fill a sequence with it exactly."""
        gap = self.size - n
        if not gap:
            return (n,)
        index.count[n] -= 1
        found = index.single(gap) or index.pair(gap) or index.triple(gap)
        index.count[n] += 1
        return (n, *found) if found else None

    def _best_fit(self, rest: list[tuple[int, int]]) -> None:
        """Open sequences by gap, those with equal contents as one with a count."""
        gaps: list[int] = []
        opened: dict[int, list[tuple[tuple[int, ...], int]]] = {}

        def put(contents: tuple[int, ...], times: int) -> None:
            gap = self.size - sum(contents)
            if not times:
                return
            if gap == 0:
                self.patterns.append((contents, times))
                return
            if gap not in opened:
                insort(gaps, gap)
                opened[gap] = []
            opened[gap].append((contents, times))

        for n, count in rest:
            while count:
                at = bisect_right(gaps, n - 1)
                if at == len(gaps):
                    each = self.size // n
                    put((n,) * each, count // each)
                    put((n,) * (count % each), 1 if count % each else 0)
                    break
                gap = gaps[at]
                contents, times = opened[gap].pop()
                if not opened[gap]:
                    del opened[gap]
                    gaps.pop(at)
                more = min(gap // n, count)
                used = min(times, count // more)
                put(contents, times - used)
                put(contents + (n,) * more, used)
                count -= used * more
        self.patterns += [entry for entries in opened.values() for entry in entries]

    def table(self) -> pd.DataFrame:
        """``length, first, last, sequence, offset``: which ranks of a length go where.

        The piece of rank ``r`` (first <= r <= last) goes to sequence ``sequence + r - first``.
        """
        used: dict[int, int] = {}
        rows, sequence = [], 0
        for contents, times in self.patterns:
            offset = 0
            for n in contents:
                first = used.get(n, 0)
                rows.append((n, first, first + times - 1, sequence, offset))
                used[n] = first + times
                offset += n
            sequence += times
        return pd.DataFrame(rows, columns=["length", "first", "last", "sequence", "offset"])


def placed(cut: DataFrame, length: int = LENGTH) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces (``doc_id, piece, length, place``, other columns but ``place`` stay).

    ``place`` is any number that tells repeated rows apart and stays the same when the rows are read again.

    Pieces of one length are interchangeable; they take the plan's places by rank. The driver sees
    the counts of at most ``length`` different lengths and makes a plan whose number of lines is
    bounded by them; it is broadcast.
    """
    kept = [c for c in cut.columns if c != "place"]
    counts = {int(r["length"]): int(r["n"]) for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = Plan(counts, length).table().sort_values(["length", "first"], kind="stable")
    places = {int(n): tuple(g[c].to_numpy() for c in ("first", "sequence", "offset")) for n, g in plan.groupby("length")}
    spread = cut.sparkSession.sparkContext.broadcast(places)

    @F.pandas_udf("sequence_id long, offset long")
    def place(lengths: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        made = np.zeros((2, len(lengths)), np.int64)
        rank = ranks.to_numpy()
        for n, rows in lengths.groupby(lengths).indices.items():
            first, sequence, offset = spread.value[n]
            at = np.searchsorted(first, rank[rows], side="right") - 1
            made[0, rows] = sequence[at] + rank[rows] - first[at]
            made[1, rows] = offset[at]
        return pd.DataFrame({"sequence_id": made[0], "offset": made[1]})

    # the row's place spreads repeated ids, too
    key = F.xxhash64("doc_id", "piece", "place")
    even = F.shiftrightunsigned(key, 11).cast("double") / F.lit(float(2**53))
    numbered = ranked(cut, ["length"], [key, "doc_id", "piece", "place"], bucket_of(even), "rank_here", "of_length")
    # signed order within a bucket differs from that of the buckets, which a rank does not mind
    return numbered.withColumn("placed", place("length", "rank_here")).select(*kept, "placed.sequence_id", "placed.offset")


def packed(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """``pieces`` of the documents with their places. The texts are read once."""
    cut = pieces(docs, tokenizer_path).withColumn("place", F.monotonically_increasing_id())
    return placed(stored(cut, "pieces"))
