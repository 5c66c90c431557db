"""Whitening against numpy's own eigenvectors."""

import numpy as np
import pytest

from loanlens.llm import whitening
from loanlens.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def plain(vectors, number=8):
    """n, deviations, projections without signs, explained, from numpy's own decomposition of the exact covariance."""
    x = [[int(np.floor(float(c) * 1024)) + 100_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(column) for column in zip(*x, strict=True)]
    away = np.array([[n * v - s for v, s in zip(row, sums, strict=True)] for row in x], dtype=object)
    y = (away / n).astype(float)
    values, basis = np.linalg.eigh(y.T @ y / n)
    values, basis = values[::-1][:number], basis[:, ::-1][:, :number]
    return n, [sum(int(a) ** 2 for a in row) for row in away], np.abs(y @ basis / np.sqrt(values)), values / np.trace(y.T @ y / n)


def check(got, ids, vectors, number=8):
    n, away, projected, explained = plain(vectors, number)
    assert sorted((r["vec_id"], r["component"]) for r in got) == sorted((i, c) for i in ids for c in range(1, projected.shape[1] + 1))
    place = {i: k for k, i in enumerate(ids)}
    signs = {}
    for r in got:
        k, c = place[r["vec_id"]], r["component"] - 1
        assert r["n"] == n and r["deviation"] == away[k] and r["identity_error"] < 1e-9
        assert r["explained"] == pytest.approx(explained[c], rel=1e-9)
        assert abs(r["whitened"]) == pytest.approx(projected[k][c], abs=1e-7)
        signs.setdefault(c, []).append(r["whitened"])
    for values in signs.values():  # a component keeps its sign, so its mean is zero and its variance one
        assert abs(np.mean(values)) < 1e-9 and np.mean(np.square(values)) == pytest.approx(1)


def test_op13_all_vectors(spark):
    rows = spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()
    check(QUERIES["op13_qdwh_whitening"](spark, FOLDER).collect(), [r["vec_id"] for r in rows], [r["embedding"] for r in rows])


@pytest.mark.parametrize("size", [1, 2, 3, 8, 33, 120])
@pytest.mark.parametrize("shape", ["random", "graded", "clustered", "diagonal", "low rank", "pairs"])
def test_components(size, shape):
    random = np.random.default_rng(size)
    basis = np.linalg.qr(random.standard_normal((size, size)))[0]
    values = {
        "random": random.uniform(0.1, 5, size),
        "graded": 10.0 ** -np.linspace(0, 12, size),
        "clustered": np.where(np.arange(size) % 3 == 0, 2.0, 1.0),
        "diagonal": np.arange(size, 0, -1.0),
        "low rank": np.where(np.arange(size) < 2, 3.0 + np.arange(size), 0.0),
        "pairs": np.repeat(np.arange(1.0, size + 1), 2)[:size],
    }[shape]
    matrix = np.diag(values) if shape == "diagonal" else (basis * values) @ basis.T
    matrix = (matrix + matrix.T) / 2
    got, vectors = whitening.components_of(matrix, 8)
    scale = np.abs(values).max()
    assert np.allclose(got, np.sort(values)[::-1][:8], atol=1e-13 * scale * size, rtol=0)
    assert np.abs(vectors.T @ vectors - np.eye(len(got))).max() < 1e-13 * size
    assert np.abs(matrix @ vectors - vectors * got).max() < 1e-13 * size * scale


def test_odd_vectors(spark):
    random = np.random.default_rng(1)
    good = [(i, random.standard_normal(3).tolist()) for i in range(40)] + [(5, [0.5, 0.25, 1.0]), (None, [0.5, 0.25, 1.0]), (90, [0.0, -0.0, 0.0])]
    bad = [(50, None), (51, [1.0, None, 2.0]), (52, [float("nan"), 0.0, 0.0]), (53, [float("inf"), 0.0, 0.0]), (54, [1.0]), (55, [])]
    schema = "vec_id long, embedding array<double>, n long, vector int, component string, whitened double"
    df = spark.createDataFrame([(i, v, 7, 7, "x", 0.5) for i, v in good + bad], schema)
    got = whitening.whiten(df).withColumnRenamed("id", "vec_id").collect()
    assert len(got) == 3 * len(good) and {r["component"] for r in got} == {1, 2, 3}
    n, away, projected, _ = plain([v for _, v in good])
    assert sorted((r["deviation"], r["component"], round(abs(r["whitened"]), 6)) for r in got) == sorted(
        (a, c + 1, round(p[c], 6)) for a, p in zip(away, projected, strict=True) for c in range(3)
    )


def test_numbers_too_large_for_a_long(spark):
    df = spark.createDataFrame([(1, [1e17, 1.0]), (2, [-1e17, 2.0]), (3, [0.0, 0.0])], "vec_id long, embedding array<double>")
    got = whitening.whiten(df).collect()
    assert {r["n"] for r in got} == {3} and {r["component"] for r in got} >= {1}
    assert {(r["id"], r["deviation"]) for r in got if r["id"] != 3} == {(1, None), (2, None)}
    assert max(r["identity_error"] for r in got) < 1e-9


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, [])]])
def test_nothing_to_whiten(spark, rows):
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert got.count() == 0
    assert got.columns == ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
