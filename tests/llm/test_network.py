"""The quality classifier against plain Python: word vectors, pooling, network, temperature, scores."""

import math
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from loanlens.llm import quality

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def given(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    return docs, spark.read.parquet(f"{FOLDER}/labels.parquet")


def slots_of(text):
    shown = ["<capitals>" if len(t) > 1 and t.isupper() else t.lower() for t in quality.TOKEN.findall(text or "")]
    return [crc32(t.encode("utf-8", "surrogatepass")) % quality.SLOTS for t in shown]


def unit(row):
    return [v / max(math.sqrt(math.fsum(x * x for x in row)), 1e-12) for v in row]


def plain_vectors(texts):
    places, signs = quality.index_vectors()
    sums = Counter()
    for text in texts:
        found = slots_of(text)
        for at, slot in enumerate(found):
            for other in range(max(at - quality.WINDOW, 0), min(at + quality.WINDOW + 1, len(found))):
                if other != at:
                    for place, sign in zip(places[found[other]], signs[found[other]], strict=True):
                        sums[slot, int(place)] += int(sign)
    contexts = {}
    for (slot, place), value in sums.items():
        contexts.setdefault(slot, [0] * quality.DIMENSIONS)[place] = value
    contexts = {slot: unit(row) for slot, row in contexts.items() if any(row)}
    mean = [math.fsum(row[d] for row in contexts.values()) / len(contexts) for d in range(quality.DIMENSIONS)]
    vectors = []
    for slot in range(quality.SLOTS):
        own = [0.0] * quality.DIMENSIONS
        for place, sign in zip(places[slot], signs[slot], strict=True):
            own[place] = sign
        around = [v - m for v, m in zip(contexts[slot], mean, strict=True)] if slot in contexts else [0.0] * quality.DIMENSIONS
        vectors.append(unit([a + b for a, b in zip(unit(own), unit(around), strict=True)]))
    return vectors


def plain_score(text, vectors, network):
    found = slots_of(text)
    features = [0.0] * quality.FEATURES
    if found:
        kinds = sorted(set(found))
        mean = [math.fsum(vectors[s][d] for s in found) / len(found) for d in range(quality.DIMENSIONS)]
        each = [math.fsum(vectors[s][d] for s in kinds) / len(kinds) for d in range(quality.DIMENSIONS)]
        features = [*mean, *each, math.log(len(found)) / 10, len(kinds) / len(found)]
    a, b, c, d = network.weights
    scaled = [(x - m) / s for x, m, s in zip(features, *network.scale, strict=True)]
    inside = [math.tanh(sum(x * a[i, j] for i, x in enumerate(scaled)) + b[j]) for j in range(network.hidden)]
    return 1 / (1 + math.exp(-(sum(v * c[j, 0] for j, v in enumerate(inside)) + d[0]) / network.temperature))


def test_vectors_pooling_and_scores(given):
    docs, labels = given
    model = quality.train(docs, labels)
    texts = [r["text"] for r in docs.collect()]
    vectors = plain_vectors(texts)
    assert np.abs(np.array(vectors) - model.vectors).max() < 1e-6
    rows = quality.scored(docs, model).collect()
    assert Counter(r["text"] for r in rows) == Counter(texts)
    for row in rows:
        assert abs(row["score"] - plain_score(row["text"], vectors, model.network)) < 1e-3


def test_a_step_goes_down_the_slope():
    """The first step of Adam is the sign of the slope; slopes are told here from differences of the loss."""
    random = np.random.default_rng(3)
    x = random.normal(size=(40, 5))
    y = (x[:, 0] > 0).astype(float)
    still = quality.Network(hidden=4, rounds=1, batch=40, rate=0.0, decay=0.0)
    moved = quality.Network(hidden=4, rounds=1, batch=40, rate=1e-3, decay=0.0)
    still._train(x, y)
    moved._train(x, y)

    def loss():
        z = still.logits(x)
        return float(np.mean(np.logaddexp(0, z) - y * z))

    for start, after in zip(still.weights, moved.weights, strict=True):
        before = start.copy()
        for place in np.ndindex(start.shape):
            start[place] += 1e-5
            above = loss()
            start[place] -= 2e-5
            slope = (above - loss()) / 2e-5
            start[place] += 1e-5
            if abs(slope) > 1e-5:
                assert after[place] - before[place] == pytest.approx(-1e-3 * np.sign(slope), rel=1e-2)


def test_temperature_is_the_best_of_its_grid():
    random = np.random.default_rng(5)
    x = random.normal(size=(400, 3))
    y = (x[:, 0] + random.normal(size=400) > 0).astype(float)
    network = quality.Network(hidden=4, rounds=30).fit(x, y)
    apart = [i for i in range(400) if i % 10 == 9]

    def loss(t):
        chances = [1 / (1 + math.exp(-z / t)) for z in network.logits(x[apart])]
        return -sum(math.log(p) if y[i] else math.log(1 - p) for i, p in zip(apart, chances, strict=True))

    grid = [0.25 * 32 ** (k / 199) for k in range(200)]
    assert network.temperature == pytest.approx(min(grid, key=loss))
