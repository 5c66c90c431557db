"""Every document operator on odd rows, on columns that clash with its own, and on an empty table."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from llm_edges import EDGES
from loanlens.llm import embeddings, mixing, packing, pii, quality, search, sharding, simhash, urls, warc
from loanlens.llm.queries import tokenizer_path


def _quality(docs):
    labels = docs.sparkSession.createDataFrame([(1, 1), (7, 0), (6, 1), (None, 0), (5, None)], "doc_id long, quality int")
    return quality.scored(docs, quality.train(docs, labels))


KEEPING = {
    "shards": (lambda d: sharding.interleaved_shards(d, 4), {"shard", "slot"}),
    "simhash": (simhash.near_duplicates, {"fp", "component_id"}),
    "mix": (lambda d: mixing.sample_copies(d, mixing.words(F.col("text"))), {"size", "source_size", "target", "copies"}),
    "pii": (lambda d: pii.pseudonymized(d, "key"), set()),
    "quality": (_quality, {"score"}),
}


@pytest.mark.parametrize("name", KEEPING)
@pytest.mark.parametrize("clashing", [False, True])
def test_rows_and_other_columns_stay(documents, name, clashing):
    apply, added = KEEPING[name]
    docs = documents(EDGES, clashing)
    got = apply(docs)
    assert set(got.columns) == set(docs.columns) | added
    kept = [c for c in docs.columns if c not in added]
    rows = lambda df: Counter(tuple(r) for r in df.select(*kept).collect())
    assert rows(got) == rows(docs)


@pytest.mark.parametrize("name", KEEPING)
def test_empty_table(documents, name):
    apply, added = KEEPING[name]
    got = apply(documents([]))
    assert got.count() == 0 and added <= set(got.columns)


def test_pieces_of_odd_texts(documents):
    got = packing.packed(documents(EDGES, True), tokenizer_path()).collect()
    whole = Counter(r["doc_id"] for r in got if r["piece"] == 0)
    assert whole == Counter(i for i, _, _ in EDGES)
    assert {r["length"] for r in got if r["doc_id"] in (2, 3, 4)} == {1}
    assert packing.packed(documents([]), tokenizer_path()).count() == 0


def test_one_of_each_group(documents):
    got = simhash.one_of_each(documents(EDGES, True))
    assert set(got.columns) == set(documents(EDGES, True).columns)
    # 1 and 6 differ in capitals only; 2, 3, 4 and one without an id have no words
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in got.collect()) == [(False, 1), (False, 2), (False, 5), (False, 7), (True, 0)]
    assert simhash.one_of_each(documents([])).count() == 0


def test_mix_repeats_whole_rows(documents):
    docs = documents(EDGES, True)
    got = mixing.mixed(docs)
    assert got.columns == docs.columns
    most = {k: 2 * n for k, n in Counter(t for _, t, _ in EDGES).items()}
    assert all(n <= most[t] for t, n in Counter(r["text"] for r in got.collect()).items())
    assert mixing.mixed(documents([])).count() == 0


def test_search_odd_texts(documents, spark):
    index = search.build_index(documents(EDGES, True))
    asked = spark.createDataFrame([(0, "one SIX"), (1, None), (2, ""), (3, "absent")], "item long, text string")
    got = search.search(index, asked, "item").orderBy("rank").collect()
    assert [(r["item"], r["doc_id"]) for r in got] == [(0, 1), (0, 1), (0, 6)]
    assert search.search(search.build_index(documents([])), asked, "item").count() == 0


def test_accepted_keeps_columns(documents):
    docs = documents(EDGES, True)
    labels = docs.sparkSession.createDataFrame([], "doc_id long, quality int")
    assert quality.accepted(docs, labels).columns == docs.columns
    assert quality.accepted(docs, labels).count() == len(EDGES)  # without labels every score is 0.5


def test_vectors_repeated_and_clashing(spark):
    schema = "vec_id long, embedding array<double>, n_links string, component_id string, kept string, vector int, id int, node int"
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 1.0]), (None, [0.0, 1.0])]
    df = spark.createDataFrame([(i, v, "x", "x", "x", 7, 7, 7) for i, v in rows], schema)
    got = sorted(((r["id"] is None, r["id"] or 0), r["n_links"], r["component_id"], r["kept"]) for r in embeddings.near_duplicates(df).collect())
    assert got == [((False, 1), 2, 1, True)] * 2 + [((False, 2), 2, 1, False), ((False, 3), 1, 3, True), ((True, 0), 1, 3, False)]
    assert embeddings.near_duplicates(df.limit(0)).count() == 0


def test_pages_with_clashing_columns(spark):
    schema = "page_id long, url string, html string, host string, path string, rule string, verdict string, odds string, word string, n long"
    long = "http://x.com/" + "casinonews" * 30
    rows = [(1, "http://a.net/b", "<p>casino news</p>"), (1, "http://a.net/b", "<p>casino news</p>"), (2, None, None), (None, long, "")]
    pages = spark.createDataFrame([(*r, *["x"] * 6, 7) for r in rows], schema)
    got = urls.judged(pages).select("page_id", "host", "path", "rule", "verdict").collect()
    plain = urls.judged(pages.select("page_id", "url", "html")).select("page_id", "host", "path", "rule", "verdict").collect()
    assert Counter(map(str, got)) == Counter(map(str, plain))
    assert Counter((r["page_id"], r["host"], r["rule"]) for r in got) == {(1, "a.net", "net/"): 2, (2, "", None): 1, (None, "x.com", None): 1}


def test_archives_of_long_and_clashing_pages(spark):
    schema = "page_id long, url string, html string, payload string, payload_digest string, keeper int, archive int, offset int, refers_to int"
    long = "é" * 3_000_000
    rows = [(1, "u", long), (2, "v", long), (3, None, None), (3, None, None)]
    pages = spark.createDataFrame([(*r, "x", "x", 7, 7, 7, 7) for r in rows], schema)
    folder = warc.new_folder(spark)
    got = warc.read_records(warc.write_archives(pages, folder), folder).collect()
    told = Counter((r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in got)
    assert told == {(1, 6_000_000, "revisit", 2): 1, (2, 6_000_000, "response", None): 1, (3, 0, "response", None): 2}


def test_the_pipeline_bears_odd_and_no_documents(spark, documents, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([(1, 1, 0), (7, 0, 0), (None, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for name, rows in (("odd", EDGES), ("none", [])):
        docs, before = documents(rows, True), None
        for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
            if number:
                assert docs.columns == before
            before = docs.columns
            stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{name}-{number}")
            docs = spark.read.parquet(f"{tmp_path}/{name}-{number}")
        assert "sequence_id" in docs.columns and (docs.count() > 0) == bool(rows)


def test_near_dedup_in_a_session_that_used_its_parts_before(spark, documents):
    """Functions that travel to tasks stay fit to travel once they have been used."""
    docs = documents(EDGES)
    first = simhash.with_classes(docs).count()
    assert simhash.one_of_each(docs).count() < first == simhash.near_duplicates(docs).count()
