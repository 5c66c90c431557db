"""Each stage of the pipeline against a plain version on its own input, and the whole run."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

import __spark_entry__ as registry
import corpus_pipeline
from loanlens.llm import quality
from loanlens.llm.queries import tokenizer_path

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows before the first stage and after each."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    made = [docs]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(number))
        stage(spark, made[-1], FOLDER).write.parquet(path)
        made.append(spark.read.parquet(path))
    return made


def texts(df):
    return [(r["doc_id"], r["text"], r["source"]) for r in df.collect()]


def test_columns_stay_until_the_last(stages):
    assert all(df.columns == stages[0].columns for df in stages[:-1])
    assert "sequence_id" in stages[-1].columns


def test_quality_drops_what_it_rejects(spark, stages):
    model = quality.train(stages[0], spark.read.parquet(f"{FOLDER}/labels.parquet"))
    rows = texts(stages[0])
    scores = model.network.score(model.features([t for _, t, _ in rows]))
    assert Counter(texts(stages[1])) == Counter(r for r, s in zip(rows, scores, strict=True) if s >= quality.THRESHOLD)
    assert 0 < stages[1].count() < stages[0].count()


def test_one_of_each_group_stays(stages):
    prints = {}
    for i, text, _ in texts(stages[1]):
        words = (text or "").encode().lower().split()
        shingles = [b" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))] if words else []
        hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        prints[i] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    left, kept = set(prints), set()
    while left:
        group, new = set(), {min(left)}
        while new:
            group |= new
            new = {j for j in left - group if any((prints[i] ^ prints[j]).bit_count() <= 4 for i in new)}
        kept.add(min(group))
        left -= group
    assert sorted(i for i, _, _ in texts(stages[2])) == sorted(kept)
    assert set(texts(stages[2])) <= set(texts(stages[1]))


def test_only_personal_data_changes(stages):
    before, after = ({i: t for i, t, _ in texts(df)} for df in stages[2:4])
    assert before.keys() == after.keys()
    for i, text in before.items():
        for old, new in zip(text.split(" "), after[i].split(" "), strict=True):
            assert old == new or any(c.isdigit() for c in old)


def test_sources_come_near_their_targets(stages):
    size = lambda text: len((text or "").encode().split())
    before, after = texts(stages[3]), texts(stages[4])
    copies = Counter(after)
    assert set(copies) <= set(before) and all(n <= 2 * Counter(before)[r] for r, n in copies.items())
    sizes, largest = defaultdict(int), defaultdict(int)
    for _, text, source in before:
        sizes[source] += size(text)
        largest[source] = max(largest[source], size(text))
    taken = defaultdict(int)
    for _, text, source in after:
        taken[source] += size(text)
    weights = {s: (3, 1, 2)[k % 3] for k, s in enumerate(sorted(sizes))}
    target, open_ = {}, set(sizes)
    while open_:
        level = (1.5 * sum(sizes.values()) - sum(target.values())) / sum(weights[s] for s in open_)
        full = {s for s in open_ if level * weights[s] > 2 * sizes[s]} or open_
        target |= {s: min(2 * sizes[s], level * weights[s]) for s in full}
        open_ -= full
    assert all(-largest[s] <= taken[s] - target[s] <= 1e-6 * target[s] for s in sizes)


def test_sequences_hold_every_token_once(stages):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    want, got = Counter(), Counter()
    for i, text, _ in texts(stages[4]):
        ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids + [1], "<u4")
        want.update((i, at // 4096, zlib.crc32(ids[at : at + 4096].tobytes())) for at in range(0, len(ids), 4096))
    filled = defaultdict(list)
    for r in stages[5].collect():
        got[r["doc_id"], r["piece"], r["ids_crc32"]] += 1
        filled[r["sequence_id"]].append((r["offset"], r["length"]))
    assert got == want
    for parts in filled.values():
        ends = np.cumsum([n for _, n in sorted(parts)])
        assert ends[-1] <= 4096 and [o for o, _ in sorted(parts)] == [0, *ends[:-1]]


def test_the_registered_run(spark, stages):
    assert registry.queries()["pipeline"] is corpus_pipeline.run
    got = corpus_pipeline.run(spark, FOLDER)
    key = lambda df: Counter((r["doc_id"], r["piece"], r["ids_crc32"]) for r in df.collect())
    assert key(got) == key(stages[-1])
