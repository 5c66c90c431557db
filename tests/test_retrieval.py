import math
import re
import weakref
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loanlens.functions.text import STOP_WORDS
from loanlens.operators import postings, retrieval
from loanlens.sources.corpus import read_text_files

CORPUS = {
    "a.md": "Collections policy: prioritize high principal, repeat delinquency and failed promise to pay outcomes. " * 3,
    "b.md": "Credit policy. Manual review is required when the bureau score is between 620 and 700. " * 12,
    "c.md": "Data quality incident: null rate, duplicate keys, freshness. Ümlaut übung naïve café x_1 y",
    "d.md": "",
}
QUESTIONS = {
    "q1": "Which policy covers manual review of the bureau score?",
    "q2": "duplicate keys and null rate",
    "q3": "zzz unknown words only",
    "q4": "Übung café",
}


def brute_chunks(text):
    found = text.split()
    return [" ".join(found[i : i + 120]) for i in range(0, len(found), 95)]


def brute_terms(text):
    kept = [w for w in re.findall(r"(?u)\b\w\w+\b", text.lower()) if w not in set(STOP_WORDS)]
    return Counter(kept + [f"{a} {b}" for a, b in zip(kept, kept[1:])])


def brute_retrieve(k=3, max_features=None):
    chunks = [(s, i + 1, c) for s in sorted(CORPUS) for i, c in enumerate(brute_chunks(CORPUS[s]))]
    counts = [brute_terms(c) for _, _, c in chunks]
    total, df = Counter(), Counter()
    for c in counts:
        total.update(c)
        df.update(c.keys())
    vocab = sorted(total, key=lambda t: (-total[t], t))[:max_features]
    idf = {t: math.log((1 + len(chunks)) / (1 + df[t])) + 1 for t in vocab}

    def unit(c):
        raw = {t: n * idf[t] for t, n in c.items() if t in idf}
        length = math.sqrt(sum(w * w for w in raw.values()))
        return {t: w / length for t, w in raw.items()}

    vectors = [unit(c) for c in counts]
    out = set()
    for question_id, question in QUESTIONS.items():
        q = unit(brute_terms(question))
        scored = [(round(sum(w * v.get(t, 0) for t, w in q.items()), 9), *c[:2]) for v, c in zip(vectors, chunks)]
        for rank, (score, source, n) in enumerate(sorted(scored, reverse=True)[:k], 1):
            out.add((question_id, rank, source, n, round(score, 4)))
    return out


@pytest.fixture(scope="module")
def documents(spark):
    return spark.createDataFrame(list(CORPUS.items()), "source string, text string")


@pytest.fixture(scope="module")
def asked(spark):
    return spark.createDataFrame(list(QUESTIONS.items()), "question_id string, question string")


def hits(df):
    return {(r["question_id"], r["rank"], r["source"], r["chunk_no"], r["score"]) for r in df.collect()}


@pytest.mark.parametrize(("n", "expected"), [(0, 0), (1, 1), (95, 1), (96, 2), (120, 2), (121, 2), (191, 3)])
def test_number_of_chunks(spark, n, expected):
    text = " ".join(f"w{i}" for i in range(n))
    got = retrieval.chunks(spark.createDataFrame([("s", text)], "source string, text string")).orderBy("chunk_no").collect()
    assert [r["text"] for r in got] == brute_chunks(text) and len(got) == expected


def test_white_space_beyond_ascii_separates_words(spark):
    text = "a b c　d\x1ce f​g"
    got = retrieval.chunks(spark.createDataFrame([("s", text)], "source string, text string")).first()["text"]
    assert got == " ".join(text.split()) == "a b c d e f​g"


def test_term_counts(spark, documents):
    got = retrieval.term_counts(documents).collect()
    want = {(s, t, n) for s, text in CORPUS.items() for t, n in brute_terms(text).items()}
    assert {(r["source"], r["term"], r["tf"]) for r in got} == want and len(got) == len(want)


def test_retrieval_agrees_with_brute_force(spark, documents, asked):
    for max_features in (None, 12):
        index = retrieval.tfidf_index(documents, max_features)
        got = hits(retrieval.retrieve(asked, index))
        assert got == brute_retrieve(max_features=max_features)
    assert len([h for h in got if h[0] == "q3" and h[4] == 0.0]) == 3


def test_every_term_is_kept(spark, documents):
    index = retrieval.tfidf_index(documents)
    chunk_table = [(s, i + 1, c) for s in CORPUS for i, c in enumerate(brute_chunks(CORPUS[s]))]
    want = {(s, n, t) for s, n, c in chunk_table for t in brute_terms(c)}
    weights = retrieval.normalized(index).collect()
    assert {(r["source"], r["chunk_no"], r["term"]) for r in weights} == want and len(weights) == len(want)
    assert index.vocabulary.count() == len({t for _, _, t in want})
    length = {}
    for r in weights:
        length[r["source"], r["chunk_no"]] = length.get((r["source"], r["chunk_no"]), 0.0) + r["weight"] ** 2
    assert all(abs(v - 1) < 1e-9 for v in length.values())


def test_index_round_trip_and_citations(spark, documents, asked, tmp_path):
    retrieval.write_index(documents, str(tmp_path))
    index = retrieval.read_index(spark, str(tmp_path))
    found = retrieval.retrieve(asked, index)
    assert hits(found) == brute_retrieve()
    cited = {r["question_id"]: r["citations"] for r in retrieval.citations(found).collect()}
    assert cited["q2"][0] == "c.md#chunk-1" and all(len(c) == 3 for c in cited.values())
    texts = retrieval.with_text(found, index.chunks).collect()
    assert len(texts) == 12 and all(r["text"] == brute_chunks(CORPUS[r["source"]])[r["chunk_no"] - 1] for r in texts)


def test_text_files_keep_their_name(spark, tmp_path):
    for name, text in {"a.md": "one two\nthree", "b.md": "four", "c.txt": "no"}.items():
        (tmp_path / name).write_text(text, encoding="utf-8")
    got = {r["source"]: r["text"] for r in read_text_files(spark, str(tmp_path)).collect()}
    assert got == {"a.md": "one two\nthree", "b.md": "four"}


def test_stop_words_cover_the_tokens_of_the_spark_list(spark):
    from pyspark.ml.feature import StopWordsRemover

    listed = StopWordsRemover.loadDefaultStopWords("english")
    assert set(STOP_WORDS) == {w for w in listed if re.fullmatch(r"\w\w+", w)}


@pytest.fixture(scope="module")
def real(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet").selectExpr("cast(doc_id as string) source", "text")


def test_appended_texts_weigh_as_if_they_had_always_been_there(spark, real, asked, tmp_path):
    late = "pmod(hash(source), 3) = 0"
    retrieval.write_index(real.where(f"not ({late})"), str(tmp_path))
    grown = retrieval.append_documents(real.where(late), str(tmp_path))
    whole = retrieval.tfidf_index(real)
    key = lambda r: (r["source"], r["chunk_no"], r["term"], round(r["weight"], 9))
    assert sorted(map(key, retrieval.normalized(grown).collect())) == sorted(map(key, retrieval.normalized(whole).collect()))
    assert hits(retrieval.retrieve(asked, grown)) == hits(retrieval.retrieve(asked, whole))
    assert grown.chunks.count() == whole.chunks.count()
    flat = retrieval.weights(real).collect()
    assert sorted(map(key, flat)) == sorted(map(key, retrieval.normalized(whole).collect()))


def test_an_index_that_is_being_replaced_stays_readable(spark, documents, asked, tmp_path, monkeypatch):
    retrieval.write_index(documents, str(tmp_path))
    with monkeypatch.context() as patch:
        patch.setattr(retrieval.snapshots, "publish", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            retrieval.append_documents(spark.createDataFrame([("z.md", "bureau score")], "source string, text string"), str(tmp_path))
    assert hits(retrieval.retrieve(asked, retrieval.read_index(spark, str(tmp_path)))) == brute_retrieve()


def test_questions_open_the_shelves_of_their_terms_only(spark, documents, tmp_path):
    index = retrieval.write_index(documents, str(tmp_path))
    one = spark.createDataFrame([("q", "bureau")], "question_id string, question string")
    asked = retrieval.asked_terms(one, index)
    read = retrieval._on_shelves(index.postings, asked)
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(shelf" in plan or "PartitionFilters: [shelf" in plan
    assert read.select("shelf").distinct().count() == 1


@pytest.mark.parametrize("seed", range(5))
@pytest.mark.parametrize("k", [1, 3, 10])
def test_bounds_leave_out_no_chunk_and_save_products(seed, k):
    random = np.random.default_rng(seed)
    size, entries = 5000, []
    for term in range(30):
        chunk = np.flatnonzero(random.random(size) < 0.9 / (30 - term) ** 1.2)
        added = random.choice([0.25, 0.5, 1.0], len(chunk)) * 3 / (1 + term)
        entries.append((float(added.max(initial=0)) + 0.0, chunk, added))
    entries = [e for e in entries if len(e[1])]
    every, scores, all_products = retrieval.best_chunks(entries, size, None)
    found, best, products = retrieval.best_chunks(entries, size, k)
    least = np.sort(scores)[-k]
    want = {(int(c), float(s)) for c, s in zip(every, scores, strict=True) if s >= least}
    assert want <= {(int(c), float(s)) for c, s in zip(found, best, strict=True)}
    assert products < all_products / 2


def test_frequent_terms_by_summaries_and_exactly(spark, real):
    rows = postings.segments(real).persist()
    every = rows.where("term is not null").groupBy("term").agg(F.sum("corpus_count").alias("n")).collect()
    want = sorted(((r["term"], r["n"]) for r in every), key=lambda x: (-x[1], x[0]))
    ways = set()
    for number, most in ((1, 50), (20, 400), (200, 210), (500, 1), (10**6, 10)):
        got, by_summaries = retrieval.frequent_terms(rows, number, most)
        assert [tuple(r) for r in got.collect()] == want[:number]
        ways.add(by_summaries)
    assert ways == {True, False}


def test_segments_of_any_size_count_alike(spark, real, monkeypatch):
    def counted():
        return Counter(tuple(r) for r in retrieval.chunk_term_counts(real).collect())

    whole = counted()
    monkeypatch.setattr(postings, "SEGMENT_CHUNKS", 7)
    monkeypatch.setattr(postings, "SLICE", 3)
    assert counted() == whole


def test_odd_texts(spark):
    texts = [(None, "one two"), ("a", None), ("b", ""), ("c", "x y z"), ("d", "Two words two words"), ("d", "Two words two words"), ("e", "w" * 100_000)]
    df = spark.createDataFrame(texts, "source string, text string")
    index = retrieval.tfidf_index(df)
    want = Counter((s, t) for s, text in texts for t in brute_terms(text or ""))
    assert Counter((r["source"], r["term"]) for r in retrieval.normalized(index).collect()) == want
    empty = retrieval.tfidf_index(df.limit(0))
    assert retrieval.normalized(empty).count() == 0
    asked = spark.createDataFrame([("q", "two words")], "question_id string, question string")
    assert retrieval.retrieve(asked, empty).count() == 0
    assert retrieval.retrieve(asked, index).orderBy("rank").first()["source"] == "d"  # two equal rows are one hit


def test_packed_segments_hold_what_plain_ones_hold(spark, real):
    plain = [(r["term"], r["corpus_count"], r["df"], bytes(r["chunks"]), bytes(r["tfs"])) for r in postings.segments(real.coalesce(1)).where("term IS NOT NULL").collect()]
    packed = []
    for row in postings.packs(real.coalesce(1)).where("part >= 0").collect():
        df, total = postings.unpack_counts(bytes(row["counts"]))
        starts, chunk, tf = postings.unpack_places(df, bytes(row["chunks"]), bytes(row["tfs"]))
        terms = postings.unpack_terms(row["number"], bytes(row["terms"])).to_pylist()
        parts = spark.createDataFrame([(t,) for t in terms[:3]], "term string").select(postings.part_of(F.col("term"))).distinct().collect() if row["part"] < 3 else [[row["part"]]]
        assert [r[0] for r in parts] == [row["part"]]
        for i, term in enumerate(terms):
            own = slice(starts[i], starts[i + 1])
            packed.append((term, int(total[i]), int(df[i]), np.diff(chunk[own], prepend=0).astype("<u2").tobytes(), tf[own].tolist()))
    flat = sorted((*r[:4], postings.decoded(r[3], r[4])[1].tolist()) for r in plain)
    assert sorted(packed) == flat


def test_an_index_writes_no_row_per_term_and_segment(spark, tmp_path):
    texts = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").selectExpr("cast(doc_id as string) source", "text")
    index = retrieval.write_index(texts, str(tmp_path))
    most = index.directory.count() * (postings.PARTS + 1)
    assert index.postings.count() <= most and index.frequencies.count() <= most + postings.PARTS
    assert index.vocabulary.count() > 10 * most


class Tasks:
    """Takes the function of ``mapInArrow`` instead of a job."""

    def select(self, *columns):
        return self

    def mapInArrow(self, run, schema):
        return run


def test_a_segment_is_let_go_before_the_next_is_made(monkeypatch):
    alive, most = weakref.WeakSet(), []

    class Segment(postings.Segment):
        __hash__ = object.__hash__

        def __init__(self, *fields):
            super().__init__(*fields)
            most.append(len(alive))
            alive.add(self)

    monkeypatch.setattr(postings, "Segment", Segment)
    monkeypatch.setattr(postings, "SEGMENT_CHUNKS", 2)
    monkeypatch.setattr(postings, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    texts = pa.record_batch({"source": [str(i) for i in range(8)], "text": ["one two three"] * 8})
    made = list(postings.segments(Tasks())(iter([texts])))
    assert [b.column("segment")[0].as_py() for b in made] == [0, 0, 1, 1, 2, 2, 3, 3]
    assert most == [0, 0, 0, 0]


def test_summaries_hold_little_of_a_segment():
    rng, before, held = np.random.default_rng(4), pa.total_allocated_bytes(), []
    counts = {1: rng.integers(1, 90, 40_000), 2: rng.integers(1, 9, 5), 3: rng.integers(1, 90, 3_000)}
    rows = [(s, f"term {s} {i}", int(n)) for s, some in counts.items() for i, n in enumerate(some)]

    def batches():
        for at in range(0, len(rows), 500):
            held.append(pa.total_allocated_bytes() - before)
            segment, term, count = zip(*rows[at : at + 500], strict=True)
            yield pa.record_batch({"segment": pa.array(segment, pa.int64()), "term": term, "corpus_count": pa.array(count, pa.int64())})

    got = [b.to_pydict() for b in retrieval._summaries(100)(batches())]
    for found, (segment, some) in zip(got, counts.items(), strict=True):
        order = np.argsort(-some, kind="stable")
        assert found["term"] == [*(f"term {segment} {i}" for i in order[:100]), None]
        assert found["n"] == [*some[order[:100]].tolist(), some[order[100]] if len(order) > 100 else 0]
    assert max(held) < 200_000  # the first segment has more than a million bytes


def brute_weights(texts):
    chunks = [(s, i + 1, brute_terms(c)) for s, text in texts for i, c in enumerate(brute_chunks(text or ""))]
    df = Counter(t for *_, c in chunks for t in c)
    found = Counter()
    for source, number, c in chunks:
        raw = {t: n * (math.log((1 + len(chunks)) / (1 + df[t])) + 1) for t, n in c.items()}
        length = math.sqrt(sum(w * w for w in raw.values()))
        found.update((source, number, t, round(w / length, 9)) for t, w in raw.items())
    return found


@pytest.mark.parametrize("most", [1 << 14, 2])
def test_weights_of_odd_texts(spark, monkeypatch, most):
    """Chunks without a term count as chunks; segments without one are no trouble."""
    monkeypatch.setattr(postings, "SEGMENT_CHUNKS", most)
    monkeypatch.setattr(postings, "SLICE", most)
    again = [("d", "Two words two words"), (None, "one two"), (None, "one two " * 200), ("same", "same " * 300)]
    texts = [("a", None), ("b", ""), ("c", "x y z"), ("only", "the and of"), ("e", "w" * 100_000 + " übung"), *again, *again]
    df = spark.createDataFrame(texts, "source string, text string")
    got = [(*r[:3], round(r[3], 9)) for r in retrieval.weights(df).collect()]
    assert Counter(got) == brute_weights(texts)
    assert retrieval.weights(df.limit(0)).count() == retrieval.weights(df.where("source in ('a', 'c')")).count() == 0


def invented(spark):
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abcdefghijklmnop"), n)) for n in rng.integers(3, 9, 20_000)]
    texts = [(str(i), " ".join(words[j] for j in (20_000 * rng.random(600) ** 3).astype(int))) for i in range(400)]
    return spark.createDataFrame(texts, "source string, text string").repartition(2).persist()


def shuffled(plan):
    """Bytes that the shuffles of a plan that has run have written."""
    if plan.nodeName() == "AdaptiveSparkPlan":
        return shuffled(plan.executedPlan())
    if plan.nodeName().endswith("QueryStage"):
        return shuffled(plan.plan())
    own = plan.metrics().apply("shuffleBytesWritten").value() if plan.nodeName() == "Exchange" else 0
    return own + sum(shuffled(plan.children().apply(i)) for i in range(plan.children().size()))


def test_weights_move_terms_once_and_no_postings(spark, monkeypatch):
    monkeypatch.setattr(retrieval, "spread", lambda documents: documents)
    documents = invented(spark)
    chars = documents.agg(F.sum(F.length("text"))).first()[0]
    found = retrieval.weights(documents).agg(F.count(F.lit(1)))
    rows = found.collect()[0][0]
    moved = shuffled(found._jdf.queryExecution().executedPlan())
    assert 0 < moved < 2.5 * chars and rows > 400_000


def test_weights_come_chunk_by_chunk(spark):
    found = retrieval.weights(invented(spark)).collect()
    chunk = [(r["source"], r["chunk_no"]) for r in found]
    assert 1 + sum(a != b for a, b in zip(chunk, chunk[1:])) == len(set(chunk)) == 400 * 7
    assert sum(a["weight"] < b["weight"] - 1e-4 for a, b in zip(found, found[1:])) < len(set(chunk))
