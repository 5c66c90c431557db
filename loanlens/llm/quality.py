"""A quality classifier: random-indexing word vectors, pooled per document, and a small network.

Word vectors are gathered from all documents. Every token has a random sparse index vector; the
vector of a word is the sum of the index vectors of its neighbours, wherever it occurs. Tokens are
hashed to a fixed number of slots, so the table of vectors has the same size for any corpus.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLOTS = 1 << 14
DIMENSIONS = 48
NONZEROS = 2
WINDOW = 2
#: Slots that travel together in one row when vectors are summed.
SLOTS_PER_ROW = 256
#: Tokens summed or pooled at a time.
TOKENS_AT_ONCE = 1 << 19
#: Different tokens whose slots a task remembers before it starts anew.
REMEMBERED = 300_000
#: The network is fitted on at most so many labelled documents, the first by a digest of their ids.
LABELLED = 20_000
HELD_OUT_OF = 5
THRESHOLD = 0.3
# Runs of letters, single digits, and runs of other signs.
TOKEN = re.compile(r"[^\W\d_]+|\d|[^\w\s]+|_+")


class Slots:
    """Texts to slots, one for each token: its lower case, or one for all tokens in capitals.

    Texts are cut at blanks first; the slots of what stands between two blanks are remembered.
    """

    def __init__(self):
        self.known: dict[str, bytes] = {}

    @staticmethod
    def _of(token: str) -> int:
        shown = "<capitals>" if len(token) > 1 and token.isupper() else token.lower()
        return crc32(shown.encode("utf-8", "surrogatepass")) % SLOTS

    def __call__(self, text: str | None) -> np.ndarray:
        """The slots of a whole text, in order."""
        words = (text or "").split()
        if len(self.known) > REMEMBERED:
            self.known.clear()
        for word in set(words):
            if word not in self.known:
                self.known[word] = array("i", map(self._of, TOKEN.findall(word))).tobytes()
        return np.frombuffer(b"".join(map(self.known.__getitem__, words)), dtype=np.int32)


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the nonzeros of each slot's random index vector."""
    random = np.random.default_rng(7)
    places = np.argsort(random.random((SLOTS, DIMENSIONS)), axis=1)[:, :NONZEROS]
    signs = random.integers(0, 2, (SLOTS, NONZEROS)) * 2 - 1
    return places, signs.astype(np.float64)


def _context_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    places, signs = index_vectors()
    # one slot more stands between documents; it gives its neighbours nothing
    places, signs = np.vstack([places, 0 * places[:1]]), np.vstack([signs, 0 * signs[:1]])
    sums, slots, gap = np.zeros((SLOTS + 1) * DIMENSIONS), Slots(), np.full(WINDOW, SLOTS, np.int32)

    def add(found: np.ndarray) -> None:
        start = found * DIMENSIONS
        for k in range(NONZEROS):
            place, sign = places[found, k], signs[found, k]
            for away in range(1, WINDOW + 1):
                np.add(sums, np.bincount(start[away:] + place[:-away], sign[:-away], len(sums)), out=sums)
                np.add(sums, np.bincount(start[:-away] + place[away:], sign[away:], len(sums)), out=sums)

    for batch in batches:
        waiting, held = [], 0
        for text in batch.column(0):
            found = slots(text.as_py())
            waiting += [found, gap]
            held += len(found)
            if held >= TOKENS_AT_ONCE:
                add(np.concatenate(waiting))
                waiting, held = [], 0
        if held:
            add(np.concatenate(waiting))
    table = sums[: SLOTS * DIMENSIONS].astype(np.int64).reshape(-1, SLOTS_PER_ROW * DIMENSIONS)
    used = np.flatnonzero(table.any(axis=1))
    yield pa.RecordBatch.from_arrays(
        [pa.array(used.astype(np.int32)), pa.array([table[u].tobytes() for u in used], pa.binary())], names=["part", "sums"]
    )


def _add_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, sums in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            more = np.frombuffer(sums.as_buffer(), np.int64)
            total[part] = total[part] + more if part in total else more.copy()
    if total:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())], names=["part", "sums"]
        )


def word_vectors(texts: DataFrame) -> np.ndarray:
    """A unit vector per slot, from all texts (one column): own index vector plus that of its contexts.

    Each task adds up its own table and sends it in a few rows; the driver gets one table of fixed
    size. The sums are whole numbers, so their order does not matter.
    """
    schema = "part int, sums binary"
    summed = texts.mapInArrow(_context_sums, schema).repartition("part").mapInArrow(_add_sums, schema)
    table = np.zeros((SLOTS // SLOTS_PER_ROW, SLOTS_PER_ROW * DIMENSIONS))
    for row in summed.collect():
        table[row["part"]] += np.frombuffer(row["sums"], np.int64)
    contexts = table.reshape(SLOTS, DIMENSIONS)
    places, signs = index_vectors()
    own = np.zeros((SLOTS, DIMENSIONS))
    np.put_along_axis(own, places, signs, axis=1)
    seen = np.abs(contexts).sum(axis=1) > 0
    contexts = _unit(contexts)
    contexts[seen] -= contexts[seen].mean(axis=0) if seen.any() else 0
    return _unit(_unit(own) + _unit(contexts)).astype(np.float32)


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


FEATURES = 2 * DIMENSIONS + 2


def pooled(found: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Mean vector of the tokens, mean vector of the different tokens, length and variety."""
    if not len(found):
        return np.zeros(FEATURES, np.float32)
    kinds, counts = np.unique(found, return_counts=True)
    each = vectors[kinds]
    mean = counts @ each / len(found)
    return np.concatenate([mean, each.mean(axis=0), [np.log(len(found)) / 10, len(kinds) / len(found)]]).astype(np.float32)


@dataclass
class Network:
    """Two layers, trained by Adam; its logit is divided by a temperature fitted on rows set apart."""

    hidden: int = 32
    rounds: int = 60
    batch: int = 128
    rate: float = 3e-3
    decay: float = 1e-4
    weights: list[np.ndarray] = field(default_factory=list)
    scale: tuple[np.ndarray, np.ndarray] = None
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        if not self.weights:
            return np.zeros(len(x))
        a, b, c, d = self.weights
        return np.tanh((x - self.scale[0]) / self.scale[1] @ a + b) @ c[:, 0] + d[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x.astype(np.float64)) / self.temperature, -30, 30)))

    def fit(self, x: np.ndarray, y: np.ndarray) -> Network:
        """No rows: every score is 0.5. Every tenth row is kept for the temperature."""
        if not len(y):
            return self
        apart = np.arange(len(y)) % 10 == 9
        self._train(x[~apart].astype(np.float64), y[~apart])
        if apart.any():
            self._calibrate(x[apart].astype(np.float64), y[apart])
        return self

    def _train(self, x: np.ndarray, y: np.ndarray) -> None:
        random = np.random.default_rng(1)
        self.scale = (x.mean(axis=0), x.std(axis=0) + 1e-3)
        x = (x - self.scale[0]) / self.scale[1]
        rate = np.clip(y.mean(), 0.01, 0.99)
        w = [
            random.normal(0, x.shape[1] ** -0.5, (x.shape[1], self.hidden)),
            np.zeros(self.hidden),
            random.normal(0, self.hidden**-0.5, (self.hidden, 1)),
            np.array([np.log(rate / (1 - rate))]),
        ]
        first, second, step = [0 * v for v in w], [0 * v for v in w], 0
        for _ in range(self.rounds):
            order = random.permutation(len(y))
            for at in range(0, len(y), self.batch):
                rows = order[at : at + self.batch]
                inside = np.tanh(x[rows] @ w[0] + w[1])
                wrong = 1 / (1 + np.exp(-np.clip(inside @ w[2][:, 0] + w[3][0], -30, 30))) - y[rows]
                back = wrong[:, None] * w[2][:, 0] * (1 - inside**2)
                slopes = [x[rows].T @ back, back.sum(axis=0), inside.T @ wrong[:, None], np.array([wrong.sum()])]
                step += 1
                for i, slope in enumerate(slopes):
                    slope = slope / len(rows) + self.decay * w[i]
                    first[i] = 0.9 * first[i] + 0.1 * slope
                    second[i] = 0.999 * second[i] + 0.001 * slope**2
                    w[i] = w[i] - self.rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
        self.weights = w

    def _calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        z = self.logits(x)
        loss = lambda t: np.mean(np.logaddexp(0, z / t) - y * z / t)
        self.temperature = float(min(np.geomspace(0.25, 8, 200), key=loss))


@dataclass
class Model:
    vectors: np.ndarray
    network: Network

    def features(self, texts) -> np.ndarray:
        slots = Slots()
        return np.array([pooled(slots(t), self.vectors) for t in texts], dtype=np.float32).reshape(-1, FEATURES)


def held_out(doc_id) -> F.Column:
    """Rows whose labels are never learned from. A null id has no label."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT_OF == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = LABELLED) -> Model:
    """Word vectors from all ``docs``, the network from at most ``sample`` labelled ones.

    ``labels`` has ``doc_id, quality``; null qualities and null ids are passed over, of several
    labels of an id the lowest holds. The sample is the first by a digest of the id. Only texts
    enter the features.
    """
    vectors = docs.sparkSession.sparkContext.broadcast(word_vectors(docs.select("text")))
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    chosen = (
        known.groupBy("doc_id").agg(F.min("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )

    @F.pandas_udf(T.BinaryType())
    def features(texts: pd.Series) -> pd.Series:
        return pd.Series([row.tobytes() for row in Model(vectors.value, None).features(texts)], dtype=object)

    # at most ``sample`` ids are broadcast, so texts stay where they are
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "quality", features("text").alias("x")).collect()
    rows.sort(key=lambda r: (crc32(str(r["doc_id"]).encode()), bytes(r["x"])))
    x = np.array([np.frombuffer(r["x"], np.float32) for r in rows], dtype=np.float64).reshape(-1, FEATURES)
    y = np.array([float(r["quality"] > 0) for r in rows])
    return Model(vectors.value, Network().fit(x, y))


def scored(docs: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """Add ``score``: the calibrated probability that a text is good.

    Whole texts are read. Null and empty texts and texts without tokens have the score of an empty
    one. Repeated rows stay. A column ``score`` of the input is replaced.
    """
    spread = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model))  # some MB, whatever the corpus

    @F.pandas_udf(T.DoubleType())
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        sent = cloudpickle.loads(spread.value)
        for texts in batches:
            yield pd.Series(sent.network.score(sent.features(texts)))

    return docs.withColumn("score", score(F.col(f"`{text_column}`")))


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the classifier does not reject. Columns as in ``docs``."""
    passed = scored(docs.select(F.struct("*").alias("document"), "text"), train(docs, labels))
    return passed.where(F.col("score") >= threshold).select("document.*")
