"""TF-IDF retrieval over chunked text, for many questions at once.

An index is built from packed segments of postings (``postings.py``). It has four tables: ``chunks``,
the passages; ``postings``, the segments' terms by parts, laid out on shelves; ``vocabulary``, every
term with its frequencies, packed by parts, next to the whole corpus's frequencies in the order of each
segment's terms; and ``directory``, a row per segment with the texts its chunks stem from and the
lengths of the chunks' vectors. Questions meet a segment's postings in one task, in blocks of
questions, and only what can still reach a question's best chunks is scored.
"""

from __future__ import annotations

import math
import uuid
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loanlens.functions.text import STOP_WORDS, words
from loanlens.operators import postings as p
from loanlens.operators.postings import MAX_WORDS, OVERLAP
from loanlens.session import shared_folder, stored
from loanlens.sources import snapshots
from loanlens.sources.corpus import spread

TOP_K = 3
#: Shelves of the stored postings: a term's part, by its hash, is on one of them, and questions open their shelves only.
SHELVES = 16
#: Questions that meet a segment's postings at once.
QUESTIONS_AT_ONCE = 512
#: Far above what the order of additions changes in a score, far below the digits that scores are compared in.
SLACK = 1e-8
DIGITS = 9


#: The tables of a written index. Schemas are declared, so that an index without texts can be read.
WRITTEN = {
    "chunks": "source string, chunk_no int, text string",
    "vocabulary": "segment long, part int, number int, terms binary, counts binary, whole binary, n_chunks long, shelf int",
    "postings": f"{p.PACKS}, shelf int",
    "directory": "segment long, sources array<string>, firsts array<int>, befores array<int>, lengths binary",
}


@dataclass(frozen=True)
class Index:
    chunks: DataFrame  # source, chunk_no, text
    frequencies: DataFrame  # the vocabulary by parts, packed, and of each segment and part the whole corpus's frequencies
    postings: DataFrame  # shelf and the packed segments
    directory: DataFrame  # segment, sources, firsts, befores, lengths

    @property
    def vocabulary(self) -> DataFrame:
        """``term, corpus_count, df, idf``."""
        return _spelled(self.frequencies.where("shelf >= 0"))


def chunks(documents: DataFrame, max_words: int = MAX_WORDS, overlap: int = OVERLAP) -> DataFrame:
    """Overlapping windows of words over each whole text, numbered from 1 per source.

    The outer form of the generator is deliberate, here and in ``postings``:
    for the inner form the optimizer adds a filter on the size of the array
    and moves it down to the scan, where it repeats the whole text expression.

    A window starts every ``max_words - overlap`` words as long as words are
    left, so a short tail that the window before already covers is kept too.

    Words are picked by position: slicing would copy the array of a long text
    for each of its windows.
    """
    step = max_words - overlap
    last = F.size("words") - 1
    starts = F.when(last >= 0, F.sequence(F.lit(0), last, F.lit(step))).otherwise(F.array().cast("array<int>"))

    def window(start: Column) -> Column:
        positions = F.sequence(start, F.least(start + (max_words - 1), last))
        return F.array_join(F.transform(positions, lambda i: F.get("words", i)), " ")

    return (
        documents.select("source", words(F.col("text")).alias("words"))
        .select("source", F.posexplode_outer(F.transform(starts, window)).alias("pos", "text"))
        .filter("pos IS NOT NULL")
        .select("source", (F.col("pos") + 1).alias("chunk_no"), "text")
    )


def chunk_id() -> Column:
    return F.format_string("%s#chunk-%d", "source", "chunk_no").alias("chunk_id")


def term_counts(texts: DataFrame, stop_words: Sequence[str] = STOP_WORDS) -> DataFrame:
    """``source, term, tf``: the distinct uni- and bigrams of each whole text of ``texts`` (``source, text``)."""
    return p.flat_counts(texts, stop_words, whole=True).drop("chunk_no")


def chunk_term_counts(documents: DataFrame, stop_words: Sequence[str] = STOP_WORDS) -> DataFrame:
    """``source, chunk_no, term, tf`` of the chunks of ``documents`` (``source, text``)."""
    return p.flat_counts(spread(documents), stop_words)


def number_of_chunks(documents: DataFrame, max_words: int = MAX_WORDS, overlap: int = OVERLAP) -> Column:
    """How many chunks there are, from the numbers of words alone, as a value inside another plan."""
    made = F.ceil(F.size(words(F.col("text"))) / (max_words - overlap))
    return documents.select(made.alias("made")).agg(F.coalesce(F.sum("made"), F.lit(0))).scalar()


def _idf(n_chunks: Column, df: Column) -> Column:
    return F.log((n_chunks + 1.0) / (df + 1.0)) + 1.0


def vocabulary(documents: DataFrame, stop_words: Sequence[str] = STOP_WORDS) -> DataFrame:
    """``term, corpus_count, df, idf`` of every term; parts of terms meet packed."""
    rows = p.packs(spread(documents), stop_words).where("part >= 0").select("segment", "part", "number", "terms", "counts")
    found = _by_part(rows).mapInArrow(_added, ADDED).where("segment IS NULL")
    return _spelled(found.withColumn("n_chunks", number_of_chunks(spread(documents))))


def _spelled(packed: DataFrame) -> DataFrame:
    """A row per term of packed rows of a vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                df, total = p.unpack_counts(row["counts"])
                columns = [p.unpack_terms(row["number"], row["terms"]), pa.array(total), pa.array(df), pa.array(np.full(len(df), row["n_chunks"]))]
                made = pa.RecordBatch.from_arrays(columns, names=["term", "corpus_count", "df", "n_chunks"])
                yield from (made.slice(at, p.ROWS_AT_ONCE) for at in range(0, made.num_rows, p.ROWS_AT_ONCE))

    spelled = packed.select("number", "terms", "counts", "n_chunks").mapInArrow(run, "term string, corpus_count long, df long, n_chunks long")
    return spelled.select("term", "corpus_count", "df", _idf(F.col("n_chunks"), F.col("df")).alias("idf"))


def _by_part(rows: DataFrame) -> DataFrame:
    return rows.repartition("part").sortWithinPartitions("part", "segment")


ADDED = "segment long, part int, number int, terms binary, counts binary, whole binary"


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per part the frequencies of its terms over all segments: a row of the vocabulary, and a row per segment in the order of its terms.

    Where a row tells the ``only`` terms to keep, others have the frequency 0 and are not in the vocabulary.
    """
    names = [field.split()[0] for field in ADDED.split(", ")]
    for group in _per_segment(batches, "part"):
        rows = group.to_pylist()
        only = [row["only"] for row in rows if row.get("only") is not None]
        rows = [row for row in rows if row["terms"] is not None]
        if not rows:
            continue
        spelled = pa.concat_arrays([p.unpack_terms(row["number"], row["terms"]) for row in rows]).dictionary_encode()
        place, counts = spelled.indices.to_numpy(), [p.unpack_counts(row["counts"]) for row in rows]
        df, total = (np.bincount(place, np.concatenate([c[i] for c in counts])).astype(np.int64) for i in (0, 1))
        terms = spelled.dictionary
        if only:
            kept = pa.compute.is_in(terms, value_set=pa.array(only[0], pa.string())).to_numpy(zero_copy_only=False)
            df = np.where(kept, df, 0)
        ends = np.cumsum([0, *[row["number"] for row in rows]])
        made = [(r["segment"], r["part"], r["number"], None, None, p.pack(df[place[a:b]])) for r, a, b in zip(rows, ends, ends[1:])]
        there = np.flatnonzero(df)
        if len(there):
            made.append((None, rows[0]["part"], len(there), p.pack_terms(terms.take(pa.array(there))), p.pack_counts(df[there], total[there]), None))
        kinds = [pa.int64(), pa.int32(), pa.int32(), *[pa.binary()] * 3]
        yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*made, strict=True), kinds, strict=True)], names=names)


def _summaries(most: int):
    """Of each segment the ``most`` most frequent terms, and the highest count among the others as a row without a term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held, rest = None, None, 0

        def summary() -> pa.RecordBatch:
            columns = [pa.concat_arrays([held.column(0), pa.nulls(1, pa.string())]), pa.concat_arrays([held.column(1), pa.array([rest], pa.int64())])]
            return pa.RecordBatch.from_arrays(columns, names=["term", "n"])

        for batch in batches:
            numbers = batch.column("segment").to_numpy()
            starts = np.concatenate([[0], np.flatnonzero(np.diff(numbers)) + 1]) if len(numbers) else []
            for start, end in pairwise([*starts, len(numbers)]):
                if held is not None and numbers[start] != last:
                    yield summary()
                    held, rest = None, 0
                last, own = numbers[start], batch.slice(start, end - start).select(["term", "corpus_count"])
                held, dropped = _first(own if held is None else pa.Table.from_batches([held, own]).combine_chunks().to_batches()[0], most)
                rest = max(rest, dropped)
        if held is not None:
            yield summary()

    return run


def _first(rows: pa.RecordBatch, most: int) -> tuple[pa.RecordBatch, int]:
    """The ``most`` most frequent terms, and the highest count among the others."""
    counts = rows.column("corpus_count").to_numpy()
    order = np.argsort(-counts, kind="stable")
    first, others = order[:most], order[most:]
    return rows.take(pa.array(first)), int(counts[others[0]]) if len(others) else 0


def frequent_terms(rows: DataFrame, number: int, most: int | None = None) -> tuple[DataFrame, bool]:
    """``term, corpus_count`` of the ``number`` most frequent terms, ties in alphabetical order, and whether summaries sufficed.

    Each segment gives its ``most`` most frequent terms. What they add up to is at most the sum of
    the segments' highest other counts too low. So only terms that close to the ``number``-th can be
    among the first; these candidates are counted in all segments, and no other term is shuffled.
    Where that error is so large that a term outside all summaries could be among the first, all
    terms are counted. Both ways are exact.
    """
    most = most or 4 * number
    terms = rows.where("term IS NOT NULL").select("segment", "term", "corpus_count")
    summary = stored(terms.mapInArrow(_summaries(most), "term string, n long"), "summaries")
    error = summary.where("term IS NULL").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    least = summary.where("term IS NOT NULL").groupBy("term").agg(F.sum("n").alias("n"))
    last = least.orderBy(F.desc("n")).limit(number).agg(F.min("n"), F.count(F.lit(1))).first()
    sufficed = error == 0 or (last[1] == number and last[0] > error)
    if sufficed:
        candidates = least.where(F.col("n") + error >= (last[0] if last[1] == number else 0)).select("term")
        terms = terms.join(candidates, "term", "left_semi")
    counted = terms.groupBy("term").agg(F.sum("corpus_count").alias("corpus_count"))
    return counted.orderBy(F.desc("corpus_count"), "term").limit(number), sufficed


def _per_segment(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[pa.Table]:
    """The rows of each segment, from batches sorted by it."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        numbers = list(zip(*(batch.column(k).to_pylist() for k in keys), strict=True))
        start = 0
        for at, number in enumerate(numbers):
            if number != last:
                if at > start:
                    held.append(batch.slice(start, at - start))
                if held:
                    yield pa.Table.from_batches(held).combine_chunks()
                held, last, start = [], number, at
        if len(numbers) > start:
            held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


TOLD = f"{p.TEXTS}, whole binary, n_chunks long"


def _told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each segment's terms of a part how many chunks of the corpus have them, and how many chunks there are. Texts go on as they are."""
    for group in _per_segment(batches, "part"):
        if group.column("part")[0].as_py() < 0:
            yield from group.append_column("whole", pa.nulls(group.num_rows, pa.binary())).append_column("n_chunks", pa.nulls(group.num_rows, pa.int64())).to_batches()
            continue
        found = [p.unpack_part(packed) for packed in group.column("packed").to_pylist()]
        ends = np.cumsum([0, *[len(df) for _, df in found]])
        place = pa.concat_arrays([terms for terms, _ in found]).dictionary_encode().indices.to_numpy()
        whole = np.bincount(place, np.concatenate([df for _, df in found])).astype(np.int64)[place]
        packed = [p.pack_numbers(whole[a:b]) for a, b in pairwise(ends)]
        n_chunks = pa.array(np.full(group.num_rows, pa.compute.sum(group.column("size")).as_py()))
        told = group.set_column(group.column_names.index("packed"), "packed", pa.nulls(group.num_rows, pa.binary()))
        told = told.append_column("whole", pa.array(packed, pa.binary())).append_column("n_chunks", n_chunks)
        yield from told.filter(pa.array(np.diff(ends) > 0)).to_batches()


def _weighed(segment: pa.Table) -> tuple[dict, Iterator[tuple]]:
    """The head of a segment, and per part its rows, chunks and weights that are not yet divided by the lengths of the chunks."""
    rows = sorted(segment.to_pylist(), key=lambda r: r["part"])
    parts: dict[int, dict] = {}
    for row in rows:  # frequencies can come in rows of their own
        parts.setdefault(row["part"], {}).update({k: v for k, v in row.items() if v is not None})

    def found() -> Iterator[tuple]:
        for part, row in parts.items():
            if part >= 0:
                df, _ = p.unpack_counts(row["counts"])
                starts, chunk, tf = p.unpack_places(df, row["chunks"], row["tfs"])
                whole = np.frombuffer(zlib.decompress(row["whole"]), "<i8")
                idf = np.where(whole > 0, np.log((row["n_chunks"] + 1.0) / (whole + 1.0)) + 1.0, 0.0)
                yield row, starts, chunk, tf * np.repeat(idf, df)

    return parts[-1], found()


def _lengths(segment: pa.Table) -> tuple[dict, np.ndarray]:
    head, parts = _weighed(segment)
    squares = np.zeros(head["size"])
    for _, _, chunk, raw in parts:
        squares += np.bincount(chunk, raw * raw, head["size"])
    return head, np.sqrt(squares)


def _sorted_by(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.repartition(*keys).sortWithinPartitions(*keys)


def weights(documents: DataFrame, stop_words: Sequence[str] = STOP_WORDS) -> DataFrame:
    """``source, chunk_no, term, weight``: every chunk's vector in unit length. Texts are read once.

    Between tasks move the terms of each segment, spelled, to be counted, and its texts as numbers of
    words. Where a segment meets its terms' frequencies, its postings are made from the numbers again:
    they are several times as large.
    """
    rows = _by_part(p.texts(spread(documents), stop_words)).mapInArrow(_told, TOLD)
    return _sorted_by(rows, "segment").mapInArrow(_vectors, WEIGHTS)


WEIGHTS = "source string, chunk_no int, term string, weight double"


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A segment's chunks one after the other, the heaviest terms first: what is equal or alike is close together where it is written."""
    for segment in _per_segment(batches, "segment"):
        head, *told = sorted(segment.to_pylist(), key=lambda r: r["part"])
        if not told:  # texts without a term
            continue
        tokens = p.unpack_texts(head)
        codes, term, chunk = p.met(tokens)
        order, _ = p.dealt(tokens.words, codes)
        found = np.concatenate([p.unpack_numbers(row["whole"])[0][0] for row in told])
        if len(found) != len(order):
            raise ValueError(f"{len(order)} terms, {len(found)} frequencies")
        idf = np.empty(len(order))
        idf[order] = np.log((told[0]["n_chunks"] + 1.0) / (found + 1.0)) + 1.0
        place = chunk * len(codes) + term
        del chunk, term
        place, tf = np.unique(place, return_counts=True)
        chunk, term = place // len(codes), place % len(codes)
        raw = tf * idf[term]
        length = np.sqrt(np.bincount(chunk, raw * raw, tokens.size))
        near = (raw * (0xFFFF / raw.max())).astype(np.int64)
        order = np.sort(chunk << 48 | (0xFFFF - near) << 32 | np.arange(len(raw))) & 0xFFFFFFFF
        words, sources = pa.array([None, *tokens.words], pa.string()), pa.array(tokens.sources, pa.string())
        both = words.take(pa.array((codes >> 32) + 1)), words.take(pa.array(codes & 0xFFFFFFFF))
        spelled = pa.compute.binary_join_element_wise(*both, " ", null_handling="skip")
        for at in range(0, len(order), p.ROWS_AT_ONCE):
            here = order[at : at + p.ROWS_AT_ONCE]
            owner, chunk_no = p.owners(tokens.first, tokens.before, chunk[here])
            columns = [sources.take(pa.array(owner)), pa.array(chunk_no.astype(np.int32)), spelled.take(pa.array(term[here]))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(raw[here] / length[chunk[here]])], names=["source", "chunk_no", "term", "weight"])


def _flat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for segment in _per_segment(batches, "segment"):
        head, length = _lengths(segment)
        for row, starts, chunk, raw in _weighed(segment)[1]:
            term, kept = np.repeat(np.arange(row["number"]), np.diff(starts)), raw > 0
            term, chunk, weight = term[kept], chunk[kept], raw[kept] / length[chunk[kept]]
            owner, chunk_no = p.owners(head["firsts"], head["befores"], chunk)
            sources, terms = pa.array(head["sources"], pa.string()), p.unpack_terms(row["number"], row["terms"])
            for at in range(0, len(term), p.ROWS_AT_ONCE):
                here = slice(at, at + p.ROWS_AT_ONCE)
                columns = [sources.take(pa.array(owner[here])), pa.array(chunk_no[here].astype(np.int32)), terms.take(pa.array(term[here]))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(weight[here])], names=["source", "chunk_no", "term", "weight"])


def _directory(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A segment's texts, and the lengths of the vectors of its chunks."""
    kinds = [pa.int64(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary()]
    for segment in _per_segment(batches, "segment"):
        head, length = _lengths(segment)
        own = [head[name] for name in ("segment", "sources", "firsts", "befores")] + [length.tobytes()]
        yield pa.RecordBatch.from_arrays([pa.array([v], kind) for v, kind in zip(own, kinds, strict=True)], names=[f.split()[0] for f in WRITTEN["directory"].split(", ")])


CHUNK = ["source", "chunk_no"]


def tfidf_index(documents: DataFrame, max_features: int | None = None, stop_words: Sequence[str] = STOP_WORDS) -> Index:
    """The index of a corpus, written to a folder of its own below the shared one."""
    return write_index(documents, f"{shared_folder(documents.sparkSession)}/index-{uuid.uuid4().hex}", max_features, stop_words)


def write_index(documents: DataFrame, folder: str, max_features: int | None = None, stop_words: Sequence[str] = STOP_WORDS) -> Index:
    """Write the index of ``documents`` (``source, text``); what was there before is no longer part of it."""
    return _grown(documents, folder, {"chunks": [], "segments": []}, max_features, stop_words)


def append_documents(documents: DataFrame, folder: str, max_features: int | None = None, stop_words: Sequence[str] = STOP_WORDS) -> Index:
    """Add texts to a written index. Their sources must be new.

    Only the new texts are read and counted. Frequencies of all segments, old and new, are then
    added up anew, as new texts change every weight; that reads numbers and terms, no texts. Readers
    see the index as it was until the new one is complete.
    """
    found = snapshots.current(documents.sparkSession, folder)
    if found is None:
        raise ValueError(f"no index at {folder}")
    return _grown(documents, folder, {name: found[name] for name in ("chunks", "segments")}, max_features, stop_words)


def _grown(documents: DataFrame, folder: str, before: dict[str, list[str]], max_features: int | None, stop_words: Sequence[str]) -> Index:
    """Each table is derived from those already on disk, and new texts are read once for counts and once for passages."""
    spark, version, documents = documents.sparkSession, snapshots.new_version(), spread(documents)

    def written(df: DataFrame, name: str, *shelf: str) -> str:
        path = f"{folder}/versions/{version}/{name}.parquet"
        df.write.partitionBy(*shelf).parquet(path)
        return path

    passages = [*before["chunks"], written(chunks(documents), "chunks")]
    made = p.packs(documents, stop_words, len(before["segments"])).withColumn("shelf", F.when(F.col("part") < 0, -1).otherwise(_shelf(F.col("part"))))
    counted = [*before["segments"], written(made.sortWithinPartitions("shelf", "part"), "segments", "shelf")]
    rows = _read(spark, "postings", counted)
    n_chunks = rows.where("shelf = -1").agg(F.coalesce(F.sum("size"), F.lit(0))).scalar()
    terms = rows.where("shelf >= 0").select("segment", "part", "number", "terms", "counts")
    if max_features is not None:
        kept = frequent_terms(_counted(terms), max_features)[0].groupBy(p.part_of(F.col("term")).alias("part")).agg(F.collect_list("term").alias("only"))
        every = spark.range(p.PARTS).select(F.col("id").cast("int").alias("part")).join(kept, "part", "left")
        terms = terms.unionByName(every.withColumn("only", F.coalesce("only", F.array().cast("array<string>"))), allowMissingColumns=True)
    added = _by_part(terms).mapInArrow(_added, ADDED).withColumn("n_chunks", n_chunks)
    shelved = added.withColumn("shelf", F.when(F.col("segment").isNull(), _shelf(F.col("part"))).otherwise(-1))
    tables = {"chunks": passages, "segments": counted, "postings": counted, "vocabulary": [written(shelved, "vocabulary", "shelf")]}
    weighed = _with_frequencies(rows.drop("terms"), _read(spark, "vocabulary", tables["vocabulary"]))
    tables["directory"] = [written(_sorted_by(weighed, "segment").mapInArrow(_directory, WRITTEN["directory"]), "directory")]
    snapshots.publish(spark, folder, version, tables)
    return read_index(spark, folder)


def _counted(packed: DataFrame) -> DataFrame:
    """``segment, term, corpus_count`` of packed rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                columns = [pa.array(np.full(row["number"], row["segment"])), p.unpack_terms(row["number"], row["terms"]), pa.array(p.unpack_counts(row["counts"])[1])]
                yield pa.RecordBatch.from_arrays(columns, names=["segment", "term", "corpus_count"])

    return packed.mapInArrow(run, "segment long, term string, corpus_count long")


def _with_frequencies(postings: DataFrame, frequencies: DataFrame) -> DataFrame:
    """Segments next to rows of the whole corpus's frequencies of their terms. Numbers only move; no term is spelled."""
    own = postings.drop("shelf").withColumns({"whole": F.lit(None).cast("binary"), "n_chunks": F.lit(None).cast("long")})
    return own.unionByName(frequencies.where("shelf = -1").select("segment", "part", "whole", "n_chunks"), allowMissingColumns=True)


def _read(spark: SparkSession, name: str, paths: list[str]) -> DataFrame:
    """A table of an index. Folders of several builds are read side by side, each with its own shelves."""
    return reduce(DataFrame.unionByName, [spark.read.schema(WRITTEN[name]).parquet(path) for path in paths])


def read_index(spark: SparkSession, folder: str) -> Index:
    found = snapshots.current(spark, folder)
    if found is None:
        raise ValueError(f"no index at {folder}")
    return Index(*[_read(spark, name, found[name]) for name in WRITTEN])


def _shelf(part: Column) -> Column:
    return F.pmod(part, F.lit(SHELVES)).cast("int")


def _on_shelves(table: DataFrame, asked: DataFrame) -> DataFrame:
    """The rows on the shelves of the asked terms; at most SHELVES numbers come to the driver."""
    shelves = [row["shelf"] for row in asked.select(_shelf(p.part_of(F.col("term"))).alias("shelf")).distinct().collect()]
    return table.where(F.col("shelf").isin(shelves))


def normalized(index: Index) -> DataFrame:
    """The stored weights in unit length: ``source, chunk_no, term, weight``."""
    return _sorted_by(_with_frequencies(index.postings, index.frequencies), "segment").mapInArrow(_flat, WEIGHTS)


def question_weights(questions: DataFrame, vocab: DataFrame, stop_words: Sequence[str] = STOP_WORDS) -> DataFrame:
    """Questions in the space of the corpus: same vocabulary, same idf, unit length."""
    counted = term_counts(questions.select(F.col("question_id").alias("source"), F.col("question").alias("text")), stop_words)
    counted = counted.withColumnRenamed("source", "question_id")
    found = counted.join(vocab.select("term", "idf"), "term")
    raw = found.select("question_id", "term", "idf", (F.col("tf") * F.col("idf")).alias("raw"))
    # a question has at most the terms of one text
    length = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(W.partitionBy("question_id")))
    return raw.select("question_id", "term", "idf", (F.col("raw") / length).alias("question_weight"))


def asked_terms(questions: DataFrame, index: Index) -> DataFrame:
    """``question_weights`` of a stored index, written once; of the vocabulary only the shelves of their terms are read."""
    counted = term_counts(questions.select(F.col("question_id").alias("source"), F.col("question").alias("text")))
    parts = counted.select(p.part_of(F.col("term")).alias("part")).distinct()
    packed = _on_shelves(index.frequencies, counted).join(parts, "part", "left_semi")
    return stored(question_weights(questions, _spelled(packed)), "asked")


def best_chunks(entries: list[tuple], size: int, k: int | None) -> tuple[np.ndarray, np.ndarray, int]:
    """The chunks of a segment that can be among the ``k`` best, all that are met without ``k``: numbers, scores, products made.

    ``entries`` holds per term the highest weight it can add, and its chunks with what it adds to
    each. Terms come with the highest bound first. Once what is left cannot lift a chunk that no
    term has met yet above the k-th best so far, only chunks met are followed, and of those only the
    ones that what is left can still lift so far.
    """
    entries = sorted(entries, key=lambda e: -e[0])
    left = np.concatenate([np.cumsum([e[0] for e in entries][::-1])[::-1], [0.0]])
    score, followed, least, products = np.zeros(size), None, 0.0, 0
    for at, (_, chunk, added) in enumerate(entries):
        if followed is None and k is not None and least > 0 and left[at] < least - SLACK:
            met = np.flatnonzero(score)
            followed = met[score[met] + left[at] >= least - SLACK]
        if followed is None:
            score[chunk] += added
            products += len(chunk)
            reached = score[np.flatnonzero(score)]
        else:
            place = np.minimum(np.searchsorted(chunk, followed), len(chunk) - 1)
            hit = chunk[place] == followed
            score[followed[hit]] += added[place[hit]]
            products += int(hit.sum())
            reached = score[followed]
        if k is not None and len(reached) >= k:
            least = float(np.partition(reached, -k)[-k])
            if followed is not None:
                followed = followed[reached + left[at + 1] >= least - SLACK]
    found = np.flatnonzero(score) if followed is None else followed
    return found, np.round(score[found], DIGITS), products


MET = "segment long, block int, term string, idf double, chunks binary, tfs binary, asked array<struct<question_id:string,question_weight:double>>"


def _asked_postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of packed segments the postings of the terms asked for, before anything is shuffled."""
    asked = pa.list_(pa.struct([("question_id", pa.string()), ("question_weight", pa.float64())]))
    kinds = [pa.int64(), pa.int32(), pa.string(), pa.float64(), pa.binary(), pa.binary(), asked]
    names = ["segment", "block", "term", "idf", "chunks", "tfs", "asked"]
    for batch in batches:
        for at in range(batch.num_rows):
            row, found = batch.slice(at, 1).to_pylist()[0], {}
            for entry in row["asked"]:
                found.setdefault((entry["term"], entry["idf"]), []).append({k: entry[k] for k in ("question_id", "question_weight")})
            place = pa.compute.index_in(pa.array([t for t, _ in found], pa.string()), value_set=p.unpack_terms(row["number"], row["terms"])).to_pylist()
            if all(i is None for i in place):
                continue
            df, _ = p.unpack_counts(row["counts"])
            starts, chunk, tf = p.unpack_places(df, row["chunks"], row["tfs"])
            made = []
            for ((term, idf), questions), i in zip(found.items(), place, strict=True):
                if i is not None:
                    own = slice(starts[i], starts[i + 1])
                    made.append((row["segment"], row["block"], term, idf, np.diff(chunk[own], prepend=0).astype("<u2").tobytes(), tf[own].astype(tf.dtype).tobytes(), questions))
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*made, strict=True), kinds, strict=True)], names=names)


def _scored(asked: DataFrame, index: Index, mode: str, k: int, schema: str) -> DataFrame:
    """Meet questions and segments. ``mode``: the ``best`` chunks of each, ``all`` chunks met, or a ``summary`` of them.

    A task meets one segment with one block of questions. A segment's postings of a term are sent
    once per block, however many of its questions have the term.
    """
    blocks = max(1, math.ceil(asked.agg(F.countDistinct("question_id")).first()[0] / QUESTIONS_AT_ONCE))
    block = F.pmod(F.xxhash64("question_id"), F.lit(blocks)).cast("int")
    entry = F.struct("term", "idf", "question_id", "question_weight")
    by_part = asked.groupBy(block.alias("block"), p.part_of(F.col("term")).alias("part")).agg(F.collect_list(entry).alias("asked"))
    empty = lambda kind: F.lit(None).cast(kind)
    packed = _on_shelves(index.postings, asked).select("segment", "part", "number", "terms", "counts", "chunks", "tfs").join(by_part, "part")
    own = packed.mapInArrow(_asked_postings, MET).select(
        "*", *[empty(kind).alias(name) for name, kind in (("sources", "array<string>"), ("firsts", "array<int>"), ("befores", "array<int>"), ("lengths", "binary"))]
    )
    heads = index.directory.select(
        "segment", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
        *[empty(kind).alias(name) for name, kind in own.dtypes[2:7]], "sources", "firsts", "befores", "lengths",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [field.split()[0] for field in schema.split(", ")]
        for group in _per_segment(batches, "segment", "block"):
            rows = []
            heads = group.filter(pa.compute.is_null(group.column("term"))).select(["sources", "firsts", "befores", "lengths"]).to_pylist()
            terms = group.filter(pa.compute.is_valid(group.column("term")))
            if not terms.num_rows:
                continue
            head, length = heads[0], np.frombuffer(heads[0]["lengths"])
            questions: dict[str, list] = {}
            for row in terms.select(["idf", "chunks", "tfs", "asked"]).to_pylist():
                chunk, tf = p.decoded(row["chunks"], row["tfs"])
                weight = tf * row["idf"] / length[chunk]
                most = float(weight.max())
                for question in row["asked"]:
                    own = question["question_weight"]
                    questions.setdefault(question["question_id"], []).append((own * most, chunk, own * weight))
            for question, entries in questions.items():
                found, score, _ = best_chunks(entries, len(length), k if mode == "best" else None)
                if mode == "summary":
                    rows.append((question, len(found), float(score.max()), float(score.sum())))
                    continue
                owner, chunk_no = p.owners(head["firsts"], head["befores"], found)
                places = [(s, head["sources"][o], n) for s, o, n in zip(score.tolist(), owner.tolist(), chunk_no.tolist(), strict=True)]
                if mode == "best" and len(places) > k:
                    places = sorted(places, key=lambda x: (x[0], (x[1] or "").encode(), x[2]), reverse=True)[:k]
                rows += [(source, number, question, value) for value, source, number in places]
            kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "double": pa.float64()}
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, kinds[f.split()[1]]) for c, f in zip(columns, schema.split(", "), strict=True)], names=names)

    return _sorted_by(own.unionByName(heads), "segment", "block").mapInArrow(run, schema)


SCORED = "source string, chunk_no int, question_id string, score double"


def cosine(asked: DataFrame, index: Index) -> DataFrame:
    """Score of every chunk that shares a term with a question: ``source, chunk_no, question_id, score``.

    The score is kept to nine decimals, well above rounding noise, so equal passages compare as equal.
    """
    return _scored(asked, index, "all", 0, SCORED)


def cosine_summary(asked: DataFrame, index: Index) -> DataFrame:
    """``question_id, chunks_met, best_score, total_score`` over every chunk that shares a term with a question."""
    parts = _scored(asked, index, "summary", 0, "question_id string, met long, best double, total double")
    return parts.groupBy("question_id").agg(
        F.sum("met").alias("chunks_met"), F.max("best").alias("best_score"), F.sum("total").alias("total_score")
    )


def best(scored: DataFrame, k: int) -> DataFrame:
    """The ``k`` best chunks per question, equal scores in favour of the later chunk.

    Spark cuts each task's rows to ``k`` per question before they are shuffled.
    """
    order = W.partitionBy("question_id").orderBy(F.desc("score"), F.desc("source"), F.desc("chunk_no"))
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def retrieve(questions: DataFrame, index: Index, k: int = TOP_K) -> DataFrame:
    """The ``k`` best passages per question: ``question_id, rank, source, chunk_no, score``.

    ``questions`` has distinct ``question_id, question``, any number of them. Chunks of one source
    and number, of a text that was given twice, are one hit.
    """
    scored = best(_scored(asked_terms(questions, index), index, "best", k, SCORED), k)
    # A question that meets fewer than k chunks is filled up with chunks of
    # score 0, the last ones first. Of the last k chunks at most as many as it
    # did meet can be taken already.
    last = index.chunks.select(*CHUNK).orderBy(F.desc("source"), F.desc("chunk_no")).limit(k)
    fillers = questions.select(
        "question_id", F.inline(last.agg(F.collect_list(F.struct(*CHUNK))).scalar())
    ).withColumn("score", F.lit(0.0))
    candidates = (
        scored.select("question_id", *CHUNK, "score")
        .unionByName(fillers)
        .groupBy("question_id", *CHUNK)
        .agg(F.max("score").alias("score"))
    )
    return best(candidates, k).withColumn("score", F.round("score", 4))


def with_text(hits: DataFrame, chunk_table: DataFrame) -> DataFrame:
    """Add the passages. Each passage that is hit moves once, however many questions hit it.

    The hits, ``k`` per question, pick out their sources before texts are
    shuffled. Questions without matches all hit the same last chunks; adaptive
    joins split those.
    """
    hits = stored(hits, "hits")
    wanted = chunk_table.join(hits.select("source").distinct(), "source", "left_semi")
    return hits.join(wanted, CHUNK)


def citations(hits: DataFrame) -> DataFrame:
    """Per question its hit ids in order: ``question_id, citations``."""
    ranked = F.sort_array(F.collect_list(F.struct("rank", chunk_id())))
    return hits.groupBy("question_id").agg(F.transform(ranked, lambda hit: hit["chunk_id"]).alias("citations"))
