"""URL filter: rules first, then naive Bayes over segmented host and path words."""

from __future__ import annotations

import math
from bisect import insort
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.session import stored

RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
# Words that mark a URL as an example of what to block when the classifier is trained.
SEEDS = ("adult", "ads", "bets", "casino", "lottery", "pills", "poker", "porn", "spam", "viagra", "xxx")
SMOOTHING = 1.0
NUMBER = "0"
#: Letters of the parts that a task hands over at a time.
PART_LETTERS = 1 << 20

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    """After the first ``://``, A-Z lowered; empty for null or without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule(rules: Sequence[tuple[str, str]], host_: Column, path_: Column) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, or nulls; of equally long ones the first by code point.

    A rule is a host and a path and fits the host, all hosts below it, and all paths that begin
    with its own. For lists of some hundred rules; they become one expression.
    """
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for action, text in sorted(rules, key=lambda r: (len(r[1]), [-ord(c) for c in r[1]])):
        at, front = text[: text.index("/")], text[text.index("/") :]
        fits = ((host_ == at) | host_.endswith("." + at)) & path_.startswith(front)
        name, verdict = F.when(fits, F.lit(text)).otherwise(name), F.when(fits, F.lit(action)).otherwise(verdict)
    return name, verdict


def word_counts(pages: DataFrame) -> DataFrame:
    """``word, n`` over the visible text of all pages."""
    text = F.lower(F.regexp_replace("html", "<[^>]*>", " "))
    found = pages.select(F.explode(F.regexp_extract_all(text, F.lit(r"\p{L}+"), F.lit(0))).alias("word"))
    return found.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def names(host_: Column, path_: Column) -> Column:
    """Runs of letters in host and path, and a mark for each number."""
    found = F.regexp_extract_all(F.lower(F.concat(host_, path_)), F.lit(r"\p{L}+|[0-9]+"), F.lit(0))
    return F.transform(found, lambda n: F.when(n.rlike("^[0-9]"), F.lit(NUMBER)).otherwise(n))


def viterbi(name: str, found: dict[tuple[int, int], int], total: int) -> list[str]:
    """The likeliest words of ``name``.

    ``found``: counts of its parts by start and length. A part of any length that is no word counts a tenth of a
    word seen once for each letter. Of equally likely ways the one with fewer words, then with the
    longer last word.
    """
    best: list[tuple[float, int, int]] = [(0.0, 0, 0)]
    ending: dict[int, list[tuple[int, int]]] = {}
    for (start, size), count in found.items():
        ending.setdefault(start + size, []).append((start, count))
    letter, unknown = math.log(10), -math.log(max(total, 1))
    opens = [(0.0, 0, 0)]  # starts of a part that is no word, the best last; their order is the same for all ends
    for end in range(1, len(name) + 1):
        known = ending.get(end, [])
        ways = [(round(best[start][0] + math.log(count / total), 9), best[start][1] - 1, -start) for start, count in known]
        for ahead, fewer, back in reversed(opens):
            if (-back, end + back) not in found:  # else it is a word, which may be less likely than the same letters as none
                ways.append((round(ahead + unknown - end * letter, 9), fewer - 1, back))
                break
        score, fewer, start = max(ways)
        best.append((score, fewer, -start))
        insort(opens, (round(score + end * letter, 9), fewer, -end))
    words, end = [], len(name)
    while end:
        start = best[end][2]
        words.append(name[start:end])
        end = start
    return words[::-1]


def segmented(found_names: DataFrame, counts: DataFrame) -> DataFrame:
    """``name, words`` for distinct ``name``: only parts of names are looked up among the counts.

    A part has the length of a counted word; there are few different lengths, so the parts of a long
    run of letters grow with its length. They go by a digest of their name. Numbers stay one word.
    """
    lengths = counts.where("word <> ''").groupBy(F.length("word").alias("size")).agg(F.sum("n").alias("n")).collect()
    total, sizes = sum(r["n"] for r in lengths), sorted(r["size"] for r in lengths)
    whole = F.col("name") == NUMBER
    named = found_names.where(~whole).withColumn("digest", F.sha2(F.col("name"), 256))

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("digest", pa.string()), ("at", pa.int32()), ("word", pa.string())])
        for batch in batches:
            for name, digest in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for size in sizes:
                    step = max(1, PART_LETTERS // size)
                    for first in range(0, len(name) - size + 1, step):
                        places = range(first, min(first + step, len(name) - size + 1))
                        words = [name[at : at + size] for at in places]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([digest] * len(words)), pa.array(places, pa.int32()), pa.array(words, pa.string())], schema=schema
                        )

    parts = named.select("name", "digest").mapInArrow(cut_out, "digest string, at int, word string")
    known = parts.join(counts, "word").groupBy("digest").agg(F.collect_list(F.struct("at", F.length("word").alias("size"), "n")).alias("parts"))

    def split(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            lists = frame["parts"].map(lambda ps: {} if ps is None else {(p["at"], p["size"]): p["n"] for p in ps})
            words = [viterbi(name, found, total) for name, found in zip(frame["name"], lists, strict=True)]
            yield pd.DataFrame({"name": frame["name"], "words": words})

    cut = named.join(known, "digest", "left").select("name", "parts").mapInPandas(split, "name string, words array<string>")
    return cut.unionByName(found_names.where(whole).select("name", F.array("name").alias("words")))


def classified(urls: DataFrame, counts: DataFrame, seeds: Sequence[str] = SEEDS) -> DataFrame:
    """``url, odds`` for distinct ``url`` rows: log odds that a URL is to be blocked.

    URLs with a seed word among their words are the examples to block, all others those to allow;
    multinomial naive Bayes over the words of both, with add-one counts, then scores every URL by
    all its words. So hosts that share words with the examples are found without a seed.
    """
    parts = urls.withColumn("name", F.explode(names(host(F.col("url")), path(F.col("url")))))
    parts = stored(parts.select("url", "name"), "url-names")
    split = stored(segmented(parts.select("name").distinct(), counts), "segments")
    marked = split.withColumn("bad", F.exists("words", lambda w: w.isin(*seeds)).cast("int"))
    examples = stored(
        parts.join(marked, "name").groupBy("url").agg(F.max("bad").alias("bad"), F.flatten(F.collect_list("words")).alias("words")),
        "url-words",
    )
    size = examples.agg(F.count(F.lit(1)), F.coalesce(F.sum("bad"), F.lit(0))).first()
    words = examples.select("url", "bad", F.explode("words").alias("word"))
    seen = stored(
        words.groupBy("word").agg(F.sum("bad").alias("n_bad"), F.sum(1 - F.col("bad")).alias("n_good")), "word-classes"
    )
    sums = seen.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_bad"), F.lit(0)), F.coalesce(F.sum("n_good"), F.lit(0))).first()
    chance = lambda n, total: F.log((F.col(n) + SMOOTHING) / (total + SMOOTHING * sums[0]))
    model = seen.select("word", (chance("n_bad", sums[1]) - chance("n_good", sums[2])).alias("weight"))
    prior = math.log((size[1] + SMOOTHING) / (size[0] - size[1] + SMOOTHING))
    return words.join(model, "word").groupBy("url").agg((F.sum("weight") + prior).alias("odds"))


def judged(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, seeds: Sequence[str] = SEEDS) -> DataFrame:
    """``page_id, host, path, rule, verdict, odds`` for every row of ``pages`` (``page_id, url, html``).

    The rules hold where one fits; the classifier judges the rest: block if the odds are above
    zero. A URL without words, a null one too, is allowed. Each URL is judged once, however many
    rows have it; repeated rows stay. Other columns are not read, so none can clash. No pages, no
    verdicts.
    """
    counts = stored(word_counts(pages), "word-counts")
    urls = pages.where(F.col("url").isNotNull()).select("url").distinct()
    found_host, found_path = host(F.col("url")), path(F.col("url"))
    name, verdict = rule(rules, F.col("host"), F.col("path"))
    told = pages.select("page_id", "url", found_host.alias("host"), found_path.alias("path")).join(
        classified(urls, counts, seeds), "url", "left"
    )
    method = F.when(F.col("odds") > 0, F.lit("block")).otherwise(F.lit("allow"))
    return told.select("page_id", "host", "path", name.alias("rule"), F.coalesce(verdict, method).alias("verdict"), F.round("odds", 6).alias("odds"))
