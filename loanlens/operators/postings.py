"""Texts turned into segments of postings inside the tasks that read them.

A segment holds the chunks of some texts and, for each term in them, the chunks that have it and
how often. Chunks are numbered within their segment; a term's chunk numbers are sorted and stored as
differences of two bytes. A term's text is spelled once per segment, so what moves between tasks is
a term and its numbers, and not a row per term and chunk.

Counting is done on numbers: words are looked up once, two adjacent terms are one 64-bit number, and
a segment's counts come from sorted arrays. Built-in functions could count with arrays inside a row,
but walk through them element by element with comparisons of strings, which measured at ten times
the time.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.functions.text import STOP_WORDS

MAX_WORDS, OVERLAP = 120, 25
#: A segment ends after so many chunks or tokens. A slice of a long text is added at once.
SEGMENT_CHUNKS, SEGMENT_TOKENS, SLICE = 1 << 14, 1 << 20, 1 << 12
ROWS_AT_ONCE = 1 << 16
TEXTS_AT_ONCE = 64
#: Bits of a segment's number that count within a task, and within a job.
WITHIN_TASK, WITHIN_JOB = 20, 44
WORD = re.compile(r"\w\w+")

#: One pass makes both kinds of rows: terms with their postings, and slices of texts, which have no term.
ROWS = "segment long, term string, corpus_count long, df long, chunks binary, tfs binary, source string, first int, chunks_before int, chunk_count int"

#: Parts that the terms of each segment are dealt to by a hash. A part of all segments meets in one task.
PARTS = 1024
#: A segment's terms of one part in one row: ``number`` terms, their frequencies, chunks and counts, each packed. A row of
#: part -1 per segment tells the slices of texts in it.
PACKS = (
    "segment long, part int, number int, terms binary, counts binary, chunks binary, tfs binary, "
    "sources array<string>, firsts array<int>, befores array<int>, size int"
)

#: Where terms are only counted, their first word picks one of so many groups of parts, and their second word the part. A
#: row then spells a first word once, and the terms of a very common first word are still in several parts.
GROUPS = 64
#: A segment's texts as the numbers of their words, in a row of a part below 0 of its own, and its terms of each part with
#: the number of its chunks that have them, whether or not it has any. ``size``: its number of chunks.
TEXTS = "segment long, part int, size int, packed binary, sources array<string>, firsts array<int>, befores array<int>"


@dataclass
class Tokens:
    """The tokens of a segment's texts in their order, as places among ``words``, and those of each chunk."""

    sources: list[str | None]  # of each slice of a text
    first: list[int]  # its first chunk here
    before: list[int]  # how many chunks of its text come before it
    size: int  # number of chunks
    words: list[str]
    flat: np.ndarray
    starts: np.ndarray  # of each chunk's tokens
    lengths: np.ndarray

    def singles(self) -> tuple[np.ndarray, np.ndarray]:
        """Each token of each chunk: its word and the chunk."""
        return self.flat[_ranges(self.starts, self.lengths)], np.repeat(np.arange(self.size), self.lengths)

    def doubles(self) -> tuple[np.ndarray, np.ndarray]:
        """Each two adjacent tokens of each chunk: both words in one number, and the chunk."""
        shorter = np.maximum(self.lengths - 1, 0)
        left = _ranges(self.starts, shorter)
        return self.flat[left] << 32 | self.flat[left + 1], np.repeat(np.arange(self.size), shorter)


@dataclass
class Segment:
    sources: list[str | None]  # of each slice of a text
    first: list[int]  # its first chunk here
    before: list[int]  # how many chunks of its text come before it
    size: int  # number of chunks
    terms: pa.Array
    starts: np.ndarray  # of each term's postings, and the end
    chunk: np.ndarray
    tf: np.ndarray
    pairs: np.ndarray  # of each two-word term its words' places among ``terms``, which begins with the single words


def _counts(term: np.ndarray, chunk: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    key, times = np.unique(term.astype(np.int64) * size + chunk, return_counts=True)
    return key // size, key % size, times


def _emptied(parts: list[np.ndarray]) -> np.ndarray:
    """The parts as one array; they are let go, so that a segment's numbers are held once."""
    made = np.concatenate([np.empty(0, np.int64), *parts])
    parts.clear()
    return made


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its length, one after the other."""
    return np.arange(lengths.sum()) + np.repeat(starts - np.cumsum(lengths) + lengths, lengths)


class Builder:
    def __init__(self, stop_words: Sequence[str], max_words: int | None, overlap: int):
        self.stop, self.max_words, self.overlap = frozenset(stop_words), max_words, overlap
        self._clear()

    def _clear(self) -> None:
        self.ids: dict[str, int] = {}
        self.known: dict[str, tuple[int, ...]] = {}
        self.sources, self.first, self.before = [], [], []
        self.size = self.held = self.tokens = 0
        self.flat, self.starts, self.lengths = [], [], []

    def _tokens(self, word: str) -> tuple[int, ...]:
        number = self.ids.setdefault
        found = tuple(number(t, len(self.ids)) for t in WORD.findall(word.lower()) if t not in self.stop)
        self.known[word] = found
        return found

    def add(self, source: str | None, text: str | None) -> Iterator[Tokens]:
        """Take up one text; segments that are full come out."""
        words = (text or "").split()
        if self.max_words is None:
            begin, end = np.zeros(1, np.int64), np.array([len(words)])
        else:
            begin = np.arange(0, len(words), self.max_words - self.overlap)
            end = np.minimum(begin + self.max_words, len(words))
        for at in range(0, len(begin), SLICE):
            low, high = begin[at : at + SLICE], end[at : at + SLICE]
            self._slice(source, words[int(low[0]) : int(high[-1])], low - low[0], high - low[0], at)
            if self.size >= SEGMENT_CHUNKS or self.held >= SEGMENT_TOKENS:
                yield self.finished()

    def _slice(self, source: str | None, words: list[str], begin: np.ndarray, end: np.ndarray, before: int) -> None:
        known, learn = self.known, self._tokens
        found = [known[w] if w in known else learn(w) for w in words]
        reach = np.concatenate([[0], np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))])
        flat = np.fromiter(chain.from_iterable(found), np.int64, int(reach[-1]))
        lengths = reach[end] - reach[begin]
        self.flat.append(flat)
        self.starts.append(reach[begin] + self.tokens)
        self.lengths.append(lengths)
        self.sources.append(source)
        self.first.append(self.size)
        self.before.append(before)
        self.size += len(begin)
        self.tokens += len(flat)
        self.held += int(lengths.sum())

    def finished(self) -> Tokens:
        made = [_emptied(parts) for parts in (self.flat, self.starts, self.lengths)]
        found = Tokens(self.sources, self.first, self.before, self.size, list(self.ids), *made)
        self._clear()
        return found


def alphabetical(tokens: Tokens) -> Tokens:
    """The same with words in their order, so that terms in the order of their numbers are in theirs."""
    order = sorted(range(len(tokens.words)), key=tokens.words.__getitem__)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return replace(tokens, words=[tokens.words[i] for i in order], flat=rank[tokens.flat])


def met(tokens: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different terms, and of each time a chunk has one the term's place among them and the chunk.

    A term is the number of its first word, and in the lower 32 bits that of the second and one, or 0.
    """
    word, owner = tokens.singles()
    pair, pair_owner = tokens.doubles()
    codes, term = np.unique(np.concatenate([word << 32, pair + 1]), return_inverse=True)
    return codes, term, np.concatenate([owner, pair_owner])


def dealt(words: Sequence[str], codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The terms in the order of their parts, and where each part starts there, and the end."""
    code = np.fromiter((zlib.crc32(word.encode()) for word in words), np.int64, len(words))
    first, second = codes >> 32, (codes & 0xFFFFFFFF) - 1
    within = PARTS // GROUPS
    part = (code[first] % GROUPS * within + code[np.where(second < 0, first, second)] // GROUPS % within).astype(np.uint16)
    order = np.argsort(part, kind="stable")
    return order, np.searchsorted(part[order], np.arange(PARTS + 1))


def counted(tokens: Tokens) -> Segment:
    names = pa.array(tokens.words, pa.string())
    term, chunk, tf = _counts(*tokens.singles(), tokens.size)
    pair, pair_chunk = tokens.doubles()
    pairs, numbered = np.unique(pair, return_inverse=True)
    del pair
    pair, pair_chunk, pair_tf = _counts(numbered, pair_chunk, tokens.size)
    del numbered
    spelled = pc.binary_join_element_wise(names.take(pa.array(pairs >> 32)), names.take(pa.array(pairs & 0xFFFFFFFF)), " ")
    each = np.concatenate([term, pair + len(names)])
    return Segment(
        tokens.sources,
        tokens.first,
        tokens.before,
        tokens.size,
        pa.concat_arrays([names, spelled]),
        np.searchsorted(each, np.arange(len(names) + len(pairs) + 1)),
        np.concatenate([chunk, pair_chunk]),
        np.concatenate([tf, pair_tf]),
        pairs,
    )


def taken(batches: Iterator[pa.RecordBatch], stop_words: Sequence[str], max_words: int | None = MAX_WORDS, overlap: int = OVERLAP) -> Iterator[Tokens]:
    builder = Builder(stop_words, max_words, overlap)
    for batch in batches:
        for at in range(0, batch.num_rows, TEXTS_AT_ONCE):  # a batch can hold ten thousand long texts
            rows = batch.slice(at, TEXTS_AT_ONCE)
            for source, text in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True):
                yield from builder.add(source, text)
    if builder.size:
        yield builder.finished()


def built(batches: Iterator[pa.RecordBatch], stop_words: Sequence[str], max_words: int | None = MAX_WORDS, overlap: int = OVERLAP) -> Iterator[Segment]:
    return map(counted, taken(batches, stop_words, max_words, overlap))


def _binary(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    """The values of each stretch as bytes."""
    width = values.dtype.itemsize
    buffers = [None, pa.py_buffer((starts * width).astype(np.int32).tobytes()), pa.py_buffer(values.tobytes())]
    return pa.Array.from_buffers(pa.binary(), len(starts) - 1, buffers)


def coded(segment: Segment) -> tuple[pa.Array, pa.Array]:
    """Chunk numbers as differences, and frequencies, of each term."""
    steps = np.diff(segment.chunk, prepend=0)
    heads = segment.starts[:-1][np.diff(segment.starts) > 0]
    steps[heads] = segment.chunk[heads]
    small = np.uint8 if segment.tf.max(initial=0) < 256 else np.uint32
    return _binary(steps.astype("<u2"), segment.starts), _binary(segment.tf.astype(small), segment.starts)


def decoded(chunks: bytes, tfs: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Undo ``coded`` for one term."""
    chunk = np.cumsum(np.frombuffer(chunks, "<u2"), dtype=np.int64)
    return chunk, np.frombuffer(tfs, np.uint8 if len(tfs) == len(chunk) else np.uint32)


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column, and where each value ends."""
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data else np.empty(0, np.uint8), ends - ends[0]


def decoded_segment(chunks: pa.Array, tfs: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``starts, chunk, tf`` of many terms of one segment."""
    data, ends = _bytes(chunks)
    starts = ends.astype(np.int64) // 2
    total = np.cumsum(np.ascontiguousarray(data).view("<u2"), dtype=np.int64)
    before = np.concatenate([[0], total])[starts[:-1]]
    times = np.ascontiguousarray(_bytes(tfs)[0])
    return starts, total - np.repeat(before, np.diff(starts)), times if len(times) == len(total) else times.view(np.uint32)


def _rows(number: int, segment: Segment) -> Iterator[pa.RecordBatch]:
    chunks, tfs = coded(segment)
    df = np.diff(segment.starts)
    total = np.add.reduceat(np.concatenate([segment.tf, [0]]), segment.starts[:-1]) if len(df) else df
    terms, texts = len(df), len(segment.sources)
    sizes = np.diff([*segment.first, segment.size])
    empty = lambda n, kind: pa.nulls(n, kind)
    columns = [
        (pa.array(np.full(terms, number)), pa.array(np.full(texts, number))),
        (segment.terms, empty(texts, pa.string())),
        (pa.array(total.astype(np.int64)), empty(texts, pa.int64())),
        (pa.array(df.astype(np.int64)), empty(texts, pa.int64())),
        (chunks, empty(texts, pa.binary())),
        (tfs, empty(texts, pa.binary())),
        (empty(terms, pa.string()), pa.array(segment.sources, pa.string())),
        (empty(terms, pa.int32()), pa.array(segment.first, pa.int32())),
        (empty(terms, pa.int32()), pa.array(segment.before, pa.int32())),
        (empty(terms, pa.int32()), pa.array(sizes, pa.int32())),
    ]
    names = [field.split()[0] for field in ROWS.split(", ")]
    for part in (0, 1):
        made = pa.RecordBatch.from_arrays([c[part] for c in columns], names=names)
        yield from (made.slice(at, ROWS_AT_ONCE) for at in range(0, made.num_rows, ROWS_AT_ONCE))


def part_of(term: Column) -> Column:
    """The part of a term, as ``_parts`` tells it."""
    both = F.split(term, " ")
    return F.pmod(F.crc32(F.get(both, 0)) * 31 + F.crc32(F.coalesce(F.get(both, 1), F.lit(""))), F.lit(PARTS)).cast("int")


def _parts(segment: Segment) -> np.ndarray:
    singles = segment.terms.slice(0, len(segment.terms) - len(segment.pairs)).to_pylist()
    code = np.fromiter((zlib.crc32(word.encode()) for word in singles), np.int64, len(singles))
    return np.concatenate([code * 31, code[segment.pairs >> 32] * 31 + code[segment.pairs & 0xFFFFFFFF]]) % PARTS


def pack(*values: np.ndarray | memoryview) -> bytes:
    return zlib.compress(b"".join(bytes(v) for v in values), 1)


def pack_terms(terms: pa.Array) -> bytes:
    data, ends = _bytes(terms)
    return pack(np.diff(ends).astype("<i4"), data)


def unpack_terms(number: int, packed: bytes) -> pa.Array:
    raw = zlib.decompress(packed)
    ends = np.cumsum(np.concatenate([[0], np.frombuffer(raw, "<i4", number)])).astype(np.int32)
    return pa.StringArray.from_buffers(number, pa.py_buffer(ends), pa.py_buffer(raw[4 * number :]))


def pack_counts(df: np.ndarray, total: np.ndarray) -> bytes:
    return pack(df.astype("<i8"), total.astype("<i8"))


def unpack_counts(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    """In how many chunks each term is, and how often in all."""
    return tuple(np.frombuffer(zlib.decompress(packed), "<i8").reshape(2, -1))


def unpack_places(df: np.ndarray, chunks: bytes, tfs: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``starts, chunk, tf`` of the terms of a row."""
    starts, steps, times = np.concatenate([[0], np.cumsum(df)]), np.frombuffer(zlib.decompress(chunks), "<u2"), zlib.decompress(tfs)
    total = np.cumsum(steps, dtype=np.int64)
    before = np.concatenate([[0], total])[starts[:-1]]
    return starts, total - np.repeat(before, df), np.frombuffer(times, np.uint8 if len(times) == len(total) else "<u4")


def pack_numbers(*columns: np.ndarray, text: np.ndarray | bytes = b"") -> bytes:
    """Columns of numbers below 2**32: the lowest bytes of all numbers of a column come first, so the upper ones are mostly zeros in a row."""
    planes = [np.ascontiguousarray(c.astype("<u4").view(np.uint8).reshape(-1, 4).T) for c in columns]
    return pack(np.array([len(columns), *map(len, columns)], "<u4"), *planes, text)


def unpack_numbers(packed: bytes) -> tuple[list[np.ndarray], memoryview]:
    """The columns, and the text behind them."""
    raw = zlib.decompress(packed)
    number = int(np.frombuffer(raw, "<u4", 1)[0])
    lengths, at, columns = np.frombuffer(raw, "<u4", number, 4).tolist(), 4 * (number + 1), []
    for length in lengths:
        planes = np.frombuffer(raw, np.uint8, 4 * length, at).reshape(4, length)
        columns.append(np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64))
        at += 4 * length
    return columns, memoryview(raw)[at:]


def _strings(lengths: np.ndarray, text: memoryview) -> pa.Array:
    ends = np.cumsum(np.concatenate([[0], lengths])).astype(np.int32)
    return pa.StringArray.from_buffers(len(lengths), pa.py_buffer(ends), pa.py_buffer(text))


def _chunks_with(term: np.ndarray, chunk: np.ndarray, size: int, number: int) -> np.ndarray:
    """In how many chunks each of ``number`` terms is."""
    key = np.sort(term * size + chunk)
    return np.bincount(key[np.diff(key, prepend=-1) != 0] // size, minlength=number)


def _texts(number: int, tokens: Tokens) -> pa.RecordBatch:
    tokens = alphabetical(tokens)
    codes, term, chunk = met(tokens)
    df = _chunks_with(term, chunk, tokens.size, len(codes))
    del term, chunk
    order, starts = dealt(tokens.words, codes)
    df, first, second = df[order], codes[order] >> 32, codes[order] & 0xFFFFFFFF
    words = pa.array(["", *tokens.words], pa.string())
    spelled, ends = _bytes(words)
    bounds = np.diff(tokens.starts, prepend=0), tokens.lengths
    own = pack_numbers(np.diff(ends)[1:], tokens.flat, *bounds, text=spelled)
    rows = [(number, -1 - zlib.crc32(b"%d" % number) % (1 << 31), tokens.size, own, tokens.sources, tokens.first, tokens.before)]
    new = np.diff(first, prepend=-1) != 0
    new[starts[:-1][np.diff(starts) > 0]] = True
    new = np.flatnonzero(new)
    repeats, at = np.diff(new, append=len(first)), np.searchsorted(new, starts)
    (left, lefts), (right, rights) = _bytes(words.take(pa.array(first[new] + 1))), _bytes(words.take(pa.array(second)))
    for part in range(PARTS):
        low, high, a, b = *starts[part : part + 2], *at[part : part + 2]
        text = np.concatenate([left[lefts[a] : lefts[b]], right[rights[low] : rights[high]]])
        lengths = np.diff(lefts[a : b + 1]), repeats[a:b], np.diff(rights[low : high + 1])
        rows.append((number, part, tokens.size, pack_numbers(*lengths, df[low:high], text=text), None, None, None))
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.string()), *[pa.list_(pa.int32())] * 2]
    columns = [pa.array(values, kind) for values, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=[field.split()[0] for field in TEXTS.split(", ")])


def unpack_part(packed: bytes) -> tuple[pa.Array, np.ndarray]:
    """A segment's terms of a part, spelled so that each is told from others, and how many of its chunks have them."""
    (lefts, repeats, rights, df), text = unpack_numbers(packed)
    left, right = _strings(lefts, text), _strings(rights, text[int(lefts.sum()) :])
    return pc.binary_join_element_wise(left.take(pa.array(np.repeat(np.arange(len(lefts)), repeats))), right, " "), df


def unpack_texts(row: dict) -> Tokens:
    """Undo the row of a segment's texts."""
    (ends, flat, steps, lengths), text = unpack_numbers(row["packed"])
    return Tokens(row["sources"], row["firsts"], row["befores"], row["size"], _strings(ends, text).to_pylist(), flat, np.cumsum(steps), lengths)


def texts(documents: DataFrame, stop_words: Sequence[str] = STOP_WORDS) -> DataFrame:
    """All segments of ``documents`` (``source, text``) before their terms are weighed: see ``TEXTS``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << WITHIN_TASK
        for tokens in taken(batches, stop_words):
            yield _texts(task, tokens)
            del tokens  # not held while the next are read
            task += 1

    return documents.select("source", "text").mapInArrow(run, TEXTS)


def _packs(number: int, segment: Segment) -> pa.RecordBatch:
    part = _parts(segment)
    order = np.argsort(part, kind="stable")
    df = np.diff(segment.starts)[order]
    places = _ranges(segment.starts[:-1][order], df)
    starts = np.concatenate([[0], np.cumsum(df)])
    chunk, tf = segment.chunk[places], segment.tf[places]
    steps = np.diff(chunk, prepend=0)
    steps[starts[:-1]] = chunk[starts[:-1]]
    total = np.add.reduceat(np.concatenate([tf, [0]]), starts[:-1]) if len(df) else df
    steps, terms = steps.astype("<u2"), segment.terms.take(pa.array(order))
    rows = [(number, -1, 0, None, None, None, None, segment.sources, segment.first, segment.before, segment.size)]
    ends = np.searchsorted(part[order], np.arange(PARTS + 1))
    for at in np.flatnonzero(np.diff(ends)).tolist():
        low, high = int(ends[at]), int(ends[at + 1])
        own = slice(int(starts[low]), int(starts[high]))
        times = tf[own]
        rows.append((
            number, at, high - low, pack_terms(terms.slice(low, high - low)), pack_counts(df[low:high], total[low:high]),
            pack(steps[own]), pack(times.astype(np.uint8 if times.max() < 256 else "<u4")), None, None, None, None,
        ))
    kinds = [pa.int64(), pa.int32(), pa.int32(), *[pa.binary()] * 4, pa.list_(pa.string()), *[pa.list_(pa.int32())] * 2, pa.int32()]
    columns = [pa.array(values, kind) for values, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=[field.split()[0] for field in PACKS.split(", ")])


def packs(documents: DataFrame, stop_words: Sequence[str] = STOP_WORDS, generation: int = 0) -> DataFrame:
    """All segments of ``documents`` (``source, text``), packed: see ``PACKS``. What moves between tasks is a few bytes a term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = (generation << WITHIN_JOB) + (TaskContext.get().partitionId() << WITHIN_TASK)
        for segment in built(batches, stop_words):
            made = _packs(task, segment)
            del segment
            yield made
            del made  # not held while the next segment is made
            task += 1

    return documents.select("source", "text").mapInArrow(run, PACKS)


def segments(documents: DataFrame, stop_words: Sequence[str] = STOP_WORDS, generation: int = 0) -> DataFrame:
    """The rows of all segments of ``documents`` (``source, text``): see ``ROWS``. Texts without words have no chunk.

    ``generation`` keeps the numbers of segments apart that are made by different jobs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = (generation << WITHIN_JOB) + (TaskContext.get().partitionId() << WITHIN_TASK)
        for segment in built(batches, stop_words):
            yield from _rows(task, segment)
            del segment  # not held while the next is made
            task += 1

    return documents.select("source", "text").mapInArrow(run, ROWS)


def owners(first: Sequence[int], before: Sequence[int], chunk: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each chunk of a segment the slice it belongs to, and its number in the text, from 1."""
    first = np.asarray(first)
    owner = np.searchsorted(first, chunk, side="right") - 1
    return owner, chunk - first[owner] + np.asarray(before)[owner] + 1


def _flat(segment: Segment) -> Iterator[pa.RecordBatch]:
    owner, chunk_no = owners(segment.first, segment.before, segment.chunk)
    term = np.repeat(np.arange(len(segment.terms)), np.diff(segment.starts))
    sources = pa.array(segment.sources, pa.string())
    for at in range(0, len(term), ROWS_AT_ONCE):
        part = slice(at, at + ROWS_AT_ONCE)
        columns = [sources.take(pa.array(owner[part])), pa.array(chunk_no[part].astype(np.int32))]
        columns += [segment.terms.take(pa.array(term[part])), pa.array(segment.tf[part].astype(np.int32))]
        yield pa.RecordBatch.from_arrays(columns, names=["source", "chunk_no", "term", "tf"])


def flat_counts(documents: DataFrame, stop_words: Sequence[str] = STOP_WORDS, whole: bool = False) -> DataFrame:
    """``source, chunk_no, term, tf``: a row per chunk and term; each text is one chunk if ``whole``. No shuffle."""
    per_chunk = None if whole else MAX_WORDS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for segment in built(batches, stop_words, per_chunk):
            yield from _flat(segment)
            del segment  # not held while the next is made

    return documents.select("source", "text").mapInArrow(run, "source string, chunk_no int, term string, tf int")
