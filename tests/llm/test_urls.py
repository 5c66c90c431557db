import pytest
from pyspark.sql import functions as F

from loanlens.llm import urls


def test_host_path_and_rule(spark):
    rows = [
        (1, "http://A.Example.NET/en/x?q#f", "a.example.net", "/en/x", "example.net/en/", "allow"),
        (2, "https://x.net/fr", "x.net", "/fr", "net/", "block"),
        (3, "https://net", "net", "", None, "allow"),
        (4, "no scheme.net/", "", "", None, "allow"),
        (5, None, "", "", None, "allow"),
        (6, "http://examplexnet/en/", "examplexnet", "/en/", None, "allow"),
        (7, "http://É.ORG/fr/a://b", "É.org", "/fr/a://b", "org/fr/", "allow"),
        (8, "http://example.com/de/", "example.com", "/de/", "example.com/de/", "block"),
        (8, "http://example.com/de/", "example.com", "/de/", "example.com/de/", "block"),
        (None, "", "", "", None, "allow"),
        (9, "http://" + "a" * 5000 + ".com/", "a" * 5000 + ".com", "/", None, "allow"),
    ]
    pages = spark.createDataFrame([(r[0], r[1], None, "odd") for r in rows], "page_id long, url string, html string, host string")
    got = urls.judged(pages).select("page_id", "host", "path", "rule", "verdict").collect()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(key, got)) == sorted(key((r[0], *r[2:])) for r in rows)


def test_no_pages(spark):
    assert urls.judged(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def brute(name, counts, total):
    """All ways to cut a short name."""
    from itertools import combinations
    from math import log

    def ways():
        for k in range(len(name)):
            for cuts in combinations(range(1, len(name)), k):
                edges = [0, *cuts, len(name)]
                yield [name[a:b] for a, b in zip(edges, edges[1:], strict=False)]

    likely = lambda w: log(counts[w] / total) if w in counts else -log(total) - len(w) * log(10)
    return max(ways(), key=lambda ws: (round(sum(map(likely, ws)), 7), -len(ws)))


@pytest.mark.parametrize("name", ["freebets", "theheat", "zzz", "thebetsthe", "a"])
def test_viterbi_is_the_likeliest(spark, name):
    counts = {"the": 500, "he": 80, "heat": 20, "eat": 30, "at": 90, "free": 10, "bets": 5, "bet": 6, "s": 3, "a": 100}
    total = sum(counts.values())
    table = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = urls.segmented(spark.createDataFrame([(name,)], "name string"), table).first()["words"]
    assert got == brute(name, counts, total)


def test_words_of_examples_are_learned(spark):
    bad = [f"http://casinowin{k}.com/x" for k in range(20)]
    good = [f"http://news{k}.com/x" for k in range(20)]
    new = ["http://winwin.com/x", "http://newsnews.com/x"]
    html = "<p class='casino'>news win casino news win casino</p>"
    pages = spark.createDataFrame([(i, u, html) for i, u in enumerate(bad + good + new)], "page_id long, url string, html string")
    got = {r["page_id"]: r["verdict"] for r in urls.judged(pages).collect()}
    assert [got[i] for i in range(42)] == ["block"] * 20 + ["allow"] * 20 + ["block", "allow"]
    assert pages.select(F.explode(urls.names(F.lit("a-b12.com"), F.lit("/C"))).alias("n")).limit(5).count() == 5


@pytest.mark.parametrize("words", [["casino", "news"] * 8, ["donaudampfschifffahrtsgesellschaft", "news"], ["q" * 30]])
def test_words_and_names_of_any_length(spark, words):
    html = "<p>casino news donaudampfschifffahrtsgesellschaft donau dampf schifffahrt gesellschaft</p>"
    pages = spark.createDataFrame([(0, "http://x.com/", html)], "page_id long, url string, html string")
    name = spark.createDataFrame([("".join(words),)], "name string")
    assert urls.segmented(name, urls.word_counts(pages)).first()["words"] == words


def test_a_run_of_thirty_thousand_letters(spark):
    counts = spark.createDataFrame([("casino", 5), ("news", 9)], "word string, n long")
    name = spark.createDataFrame([("casinonews" * 3000,), ("0",)], "name string")
    got = {len(r["name"]): r["words"] for r in urls.segmented(name, counts).collect()}
    assert got == {30_000: ["casino", "news"] * 3000, 1: ["0"]}


def test_odds_and_verdicts_of_all_pages_are_those_of_plain_naive_bayes(spark):
    """Words as segmented, counts and odds in plain Python, over every given page."""
    from collections import Counter
    from math import log

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    counts = urls.word_counts(pages)
    named = pages.where("url IS NOT NULL").select("url", urls.names(urls.host(F.col("url")), urls.path(F.col("url"))).alias("names")).distinct().collect()
    each = spark.createDataFrame([(n,) for n in sorted({n for r in named for n in r["names"]})], "name string")
    words = {r["name"]: r["words"] for r in urls.segmented(each, counts).collect()}
    of = {r["url"]: [w for n in r["names"] for w in words[n]] for r in named}
    bad = {u for u, ws in of.items() if set(ws) & set(urls.SEEDS)}
    seen = {side: Counter(w for u, ws in of.items() if (u in bad) == side for w in ws) for side in (True, False)}
    kinds = len(seen[True] | seen[False])
    chance = lambda w, side: log((seen[side][w] + 1) / (seen[side].total() + kinds))
    prior = log((len(bad) + 1) / (len(of) - len(bad) + 1))
    odds = {u: prior + sum(chance(w, True) - chance(w, False) for w in ws) for u, ws in of.items()}
    got = urls.judged(pages).join(pages.select("page_id", "url"), "page_id").collect()
    assert len(got) == pages.count() and bad
    for row in got:
        assert row["odds"] == pytest.approx(odds[row["url"]], abs=1e-5)
        if row["rule"] is None:
            assert row["verdict"] == ("block" if odds[row["url"]] > 0 else "allow")
