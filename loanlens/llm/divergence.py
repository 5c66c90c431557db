"""How far the word frequencies of a language's sources lie apart, and which words set a source apart.

Texts are cut by one byte table: letters are lowered and every other ASCII byte becomes a blank, so
splitting at blanks yields the words. Each document is counted on its own; counts of one task are
added up before they leave it.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanlens.session import stored

#: A term is kept in a language if so many of its documents hold it.
LEAST_DOCS = 30
#: Added to every count.
PRIOR = 5
#: Frequencies are whole numbers of this part.
SCALE = 1_000_000_000
#: Terms reported per group.
TOP = 50
#: Different terms that a task adds up before it hands them on; bounds its memory, not its result.
HELD = 400_000
ROWS_AT_ONCE = 50_000


def byte_table() -> bytes:
    """Capitals to small letters, letters and all bytes beyond ASCII to themselves, the others to blanks."""
    small = range(ord("a"), ord("z") + 1)
    return bytes(b if b in small or b >= 0x80 else b + 32 if b + 32 in small else 0x20 for b in range(256))


COUNTS = "lang string, source string, term string, n long, docs long"


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = byte_table()
    terms: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    held = 0

    def handed_on() -> Iterator[pa.RecordBatch]:
        for (lang, source), (times, docs) in terms.items():
            names, n, d = list(times), list(times.values()), [docs[t] for t in times]
            for at in range(0, len(names), ROWS_AT_ONCE):
                part = slice(at, at + ROWS_AT_ONCE)
                size = len(names[part])
                columns = [pa.array([lang] * size), pa.array([source] * size), pa.array(names[part], pa.binary()).cast(pa.string())]
                columns += [pa.array(n[part], pa.int64()), pa.array(d[part], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "docs"])

    for batch in batches:
        langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for lang, source, text in zip(langs, sources, batch.column(2).cast(pa.binary()).to_pylist(), strict=True):
            own = Counter(text.translate(table).split())
            times, docs = terms.setdefault((lang, source), (Counter(), Counter()))
            held -= len(docs)
            docs.update(own.keys())
            held += len(docs)
            if times:
                get = times.get
                for term, n in own.items():
                    times[term] = get(term, 0) + n
            else:
                times.update(own)
        if held > HELD:
            yield from handed_on()
            terms.clear()
            held = 0
    yield from handed_on()


def _named(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences and documents of every term, a row per task at least that met it."""
    return _named(docs).mapInArrow(_counted, COUNTS)


def kept_terms(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """``lang, term, source, n, total``: the kept terms' occurrences per source that has them, and in the language.

    One shuffle by language and term serves the counts per source and those per language.
    """
    met = term_counts(docs).repartition("lang", "term")
    per_source = met.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    per_term = per_source.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("counts")
    )
    return per_term.where(F.col("docs") >= least_docs).select("lang", "term", "total", F.inline("counts"))


def _frequency(n: Column, of: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (n + PRIOR) / (of + PRIOR * terms)), exactly; null where nothing is kept."""
    whole = (n + PRIOR).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    floor = F.call_function("div", whole, F.nullif((of + PRIOR * terms).cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)")))
    return floor + 1


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """``lang, source, part, item, value, rank`` for every (language, source) group of ``docs``.

    Reads ``lang, source, text``; nulls count as ''. Every group and every language gives each of
    the language's kept terms (those in ``least_docs`` of its documents) a frequency, unseen ones
    too. Part `pair` has a row per other source of the language: the sum over all kept terms of how
    far the two frequencies lie apart (0 without kept terms). Part `term` has the ``top`` terms that
    the group has more often than its language, and by how much. Ranks run per group and part, the
    highest value first, ties by the item's bytes. Repeated rows count as often as they occur.
    Other columns are not read. No rows, no groups.

    Only terms that two sources share meet in a join. What a source's terms contribute against the
    frequency of an unseen term of another source is summed over the distinct frequencies, of which
    there are few; the terms that neither has need no rows at all. Work and result grow with the
    square of a language's sources, as the result lists their pairs.
    """
    kept = stored(kept_terms(docs, least_docs), "kept-terms")
    languages = kept.groupBy("lang", "term").agg(F.first("total").alias("total")).groupBy("lang")
    languages = languages.agg(F.count(F.lit(1)).alias("terms"), F.sum("total").alias("lang_total"))
    seen = kept.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("own_terms"), F.sum("n").alias("own_total"))
    zero = F.lit(0).cast("long")
    counted = _named(docs).select("lang", "source").distinct().join(seen, ["lang", "source"], "left").join(languages, "lang", "left")
    filled = counted.select("lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("own_terms", "own_total", "terms", "lang_total")])
    groups = stored(filled.withColumn("unseen", _frequency(zero, F.col("own_total"), F.col("terms"))), "groups")

    p = _frequency(F.col("n"), F.col("own_total"), F.col("terms"))
    q = _frequency(F.col("total"), F.col("lang_total"), F.col("terms"))
    rates = stored(kept.join(groups, ["lang", "source"]).select("lang", "term", "source", "unseen", p.alias("p"), q.alias("q")), "rates")
    return _pairs(groups, rates).unionByName(_terms(rates, top))


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


def _terms(rates: DataFrame, top: int) -> DataFrame:
    """Spark cuts each task's rows to ``top`` per group before they are shuffled."""
    higher = rates.where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    return _ranked(higher, "term").where(F.col("rank") <= top)


def _pairs(groups: DataFrame, rates: DataFrame) -> DataFrame:
    one = groups.select("lang", "source", "own_terms", "terms", "unseen")
    other = groups.select("lang", F.col("source").alias("item"), F.col("own_terms").alias("other_terms"), F.col("unseen").alias("other_unseen"))
    pairs = one.join(other, "lang").where("source <> item")

    # what a source's terms are apart from an unseen term of the other
    several = rates.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("times"))
    against = several.join(other.select("lang", "item", "other_unseen"), "lang").where("source <> item")
    alone = against.groupBy("lang", "source", "item").agg(F.sum(F.col("times") * F.abs(F.col("p") - F.col("other_unseen"))).alias("alone"))
    mirrored = alone.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), F.col("alone").alias("alone_other"))

    # corrected for the terms that both have
    left = rates.select("lang", "term", "source", "p", "unseen")
    right = rates.select("lang", "term", F.col("source").alias("item"), F.col("p").alias("r"), F.col("unseen").alias("other_unseen"))
    gap = lambda a, b: F.abs(F.col(a) - F.col(b))
    change = gap("p", "r") - gap("p", "other_unseen") - gap("unseen", "r") + gap("unseen", "other_unseen")
    both = left.join(right, ["lang", "term"]).where("source < item").groupBy("lang", "source", "item").agg(F.sum(change).alias("change"))
    both = both.unionByName(both.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "change"))

    keys, zero = ["lang", "source", "item"], F.lit(0).cast("long")
    joined = pairs.join(alone, keys, "left").join(mirrored, keys, "left").join(both, keys, "left")
    neither = (F.col("terms") - F.col("own_terms") - F.col("other_terms")) * gap("unseen", "other_unseen")
    value = sum((F.coalesce(c, zero) for c in ("alone", "alone_other", "change")), F.coalesce(neither, zero))
    return _ranked(joined.withColumn("value", value), "pair")
