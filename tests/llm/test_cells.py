"""Vectors in many cells against all pairs."""

import numpy as np
import pytest

from loanlens.llm import embeddings


@pytest.mark.parametrize("spread", [0.02, 1.0])
def test_no_pair_is_missed_in_many_cells(spark, monkeypatch, spread):
    monkeypatch.setattr(embeddings, "PER_CELL", 32)
    monkeypatch.setattr(embeddings, "BLOCK", 64)
    monkeypatch.setattr(embeddings, "SIDE", 128)
    random = np.random.default_rng(7)
    middles = random.normal(size=(12, 24))
    base = middles[random.integers(0, 12, 900)] * (1 - spread) + random.normal(size=(900, 24)) * max(spread, 0.3)
    unit = base / np.linalg.norm(base, axis=1, keepdims=True)
    other = random.normal(size=(500, 24))
    other -= (other * unit[:500]).sum(axis=1, keepdims=True) * unit[:500]
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    cosine = random.uniform(0.901, 0.95, 500)[:, None]
    vectors = np.concatenate([unit, cosine * unit[:500] + np.sqrt(1 - cosine**2) * other])
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    got = {r["id"]: r["n_links"] for r in embeddings.near_duplicates(frame).collect()}
    near = vectors @ vectors.T >= 0.9
    assert [got[i] for i in range(len(vectors))] == (near.sum(axis=1) - 1).tolist()
