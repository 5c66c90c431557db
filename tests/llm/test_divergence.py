"""Source divergence against SQL and a count by hand."""

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from check_oracle import compare, connection
from llm_edges import EDGES
from loanlens.llm import divergence

FOLDER = "/root/testdata/sf0.001"


def by_hand(rows, least, top):
    terms, docs = defaultdict(Counter), defaultdict(Counter)
    groups = set()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        found = [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        terms[lang, source].update(found)
        docs[lang].update(set(found))
    kept = {lang: sorted((t for t, n in docs[lang].items() if n >= least), key=str.encode) for lang, _ in groups}

    def rates(counts, lang):
        n, v = sum(counts[t] for t in kept[lang]), len(kept[lang])
        return {t: 1 + 10**9 * (counts[t] + 5) // (n + 5 * v) for t in kept[lang]}

    p = {g: rates(terms[g], g[0]) for g in groups}
    q = {lang: rates(sum((terms[g] for g in groups if g[0] == lang), Counter()), lang) for lang, _ in groups}
    out = set()
    for g in groups:
        pairs = [(o[1], sum(abs(p[g][t] - p[o][t]) for t in kept[g[0]])) for o in groups if o[0] == g[0] and o != g]
        over = [(t, p[g][t] - q[g[0]][t]) for t in kept[g[0]] if terms[g][t] and p[g][t] > q[g[0]][t]]
        for part, items, most in (("pair", pairs, None), ("term", over, top)):
            ordered = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
            out |= {(*g, part, item, value, rank) for rank, (item, value) in enumerate(ordered, 1)}
    return out


@pytest.mark.parametrize("held", [divergence.HELD, 50])
@pytest.mark.parametrize(("least", "top"), [(30, 50), (3, 7), (10**6, 50)])
def test_as_counted_by_hand(spark, monkeypatch, held, least, top):
    monkeypatch.setattr(divergence, "HELD", held)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("lang", "source", "text")
    got = [tuple(r) for r in divergence.audit(docs, least, top).collect()]
    assert len(got) == len(set(got)) and set(got) == by_hand([tuple(r) for r in docs.collect()], least, top)


@pytest.mark.parametrize("least", [1, 2])
@pytest.mark.parametrize("clashing", [False, True])
def test_odd_rows(documents, least, clashing):
    docs = documents(EDGES + [(9, "ÉTÉ été A_a a1A  x", "b")], clashing)
    if clashing:
        docs = docs.withColumnsRenamed({"size": "term", "slot": "n", "fp": "docs", "shard": "rank"})
    docs = docs.withColumn("lang", F.when(F.col("doc_id") != 6, F.col("lang")))
    got = [tuple(r) for r in divergence.audit(docs, least).collect()]
    assert len(got) == len(set(got)) and set(got) == by_hand([tuple(r) for r in docs.select("lang", "source", "text").collect()], least, 50)


def test_empty_table(documents):
    got = divergence.audit(documents([]))
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"] and got.count() == 0


def test_op12_sql(spark):
    assert compare(spark, connection(FOLDER), "op12_source_divergence", FOLDER) == ""
