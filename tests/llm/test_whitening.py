"""Whitening against dense eigenvectors, and exact deviations against whole numbers."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketframe.llm import whitening as wh

SHAPE = "vec_id long, embedding array<float>"


def plain(rows, components=32):
    """{id: (deviation, whitened)} with eigenvalues, from (id, vector) rows that are all usable."""
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in rows]
    n, sums = len(x), [sum(column) for column in zip(*x, strict=True)]
    gaps = [[n * c - s for c, s in zip(v, sums, strict=True)] for v in x]
    y = np.array([[g / n for g in row] for row in gaps])
    values, vectors = np.linalg.eigh(y.T @ y / n)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    deviations = [sum(g * g for g in row) for row in gaps]
    return deviations, y @ vectors, values, np.trace(y.T @ y / n)


def test_jacobi_davidson_reaches_double_precision():
    rng = np.random.default_rng(1)
    for d, wanted in ((3, 8), (64, 32), (300, 32)):
        a = rng.standard_normal((d, 2 * d))
        a = a @ a.T * (1 + np.arange(d)[:, None] % 5) / d
        a = (a + a.T) / 2
        a = a @ a.T
        passes = []

        def product(q, a=a, passes=passes):
            passes.append(q.shape[1])
            return a @ q

        values, vectors = wh.jacobi_davidson(product, d, wanted)
        exact = np.linalg.eigvalsh(a)[::-1][: min(d, wanted)]
        assert np.allclose(values, exact, rtol=1e-12, atol=1e-12 * exact[0])
        assert np.abs(a @ vectors - vectors * values).max() < 1e-12 * exact[0]
        assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-13)
        assert len(passes) < 400


def test_minres_solves_indefinite_systems():
    rng = np.random.default_rng(2)
    q = np.linalg.qr(rng.standard_normal((12, 12)))[0]
    a = q * np.array([5, 4, 3, 2, 1.5, 1, -1, -2, -3, 2.5, 0.5, -0.5]) @ q.T
    b = rng.standard_normal((12, 3))
    assert np.allclose(a @ wh.minres(lambda x: a @ x, b, 12), b, atol=1e-8)


@pytest.mark.parametrize("rows", [250, 3])
def test_whitening_against_dense(spark, rows):
    rng = random.Random(rows)
    data = [(i, [rng.gauss(0, 1 + k) / 8 for k in range(40)]) for i in range(rows)]
    data += [data[0], data[0]]
    df = spark.createDataFrame(data, SHAPE).repartition(5)
    df = df.select("*", F.lit(1).alias("key"), F.lit(2).alias("n"), F.lit(3).alias("component"))
    found = wh.whitened_embeddings(df).toPandas()
    deviations, projected, values, trace = plain(data)
    by_id = dict(zip([i for i, _ in data], zip(deviations, projected, strict=True), strict=True))
    real = int((values > 1e-9 * values[0]).sum())
    assert len(found) == len(data) * 32 and set(found.n) == {len(data)}
    for component in range(1, real + 1):
        part = found[found.component == component]
        want = np.array([by_id[i][1][component - 1] for i in part.vec_id])
        want /= math.sqrt(values[component - 1])
        sign = np.sign(np.dot(part.whitened, want))
        assert np.abs(part.whitened * sign - want).max() < 1e-7
        assert [by_id[i][0] for i in part.vec_id] == part.deviation.tolist()
        assert np.allclose(part.explained, values[component - 1] / trace, rtol=1e-9)
    assert found[found.component > real].whitened.isna().all()
    assert found.identity_error.max() < 1e-9


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 1.0]), (2, [0.25, -1.0]), (None, [0.0, 0.5]), (3, None), (4, [None, 1.0])]
    rows += [(5, [nan, 1.0]), (6, [inf, 0.0]), (7, [1.0]), (8, []), (9, [3e38, 0.0]), (1, [0.5, 1.0])]
    found = wh.whitened_embeddings(spark.createDataFrame(rows, SHAPE)).collect()
    assert sorted((str(r.vec_id), r.component) for r in found) == [
        ("1", 1), ("1", 1), ("1", 2), ("1", 2), ("2", 1), ("2", 2), ("None", 1), ("None", 2)
    ]
    kept = [r for r in rows if r[0] in (1, 2, None)]
    deviations = dict(zip([r[0] for r in kept], plain(kept)[0], strict=True))
    assert all(r.deviation == deviations[r.vec_id] for r in found)


def test_no_variance_and_no_rows(spark):
    same = wh.whitened_embeddings(spark.createDataFrame([(1, [1.0, 2.0])] * 3, SHAPE)).collect()
    assert len(same) == 6
    assert all((r.deviation, r.whitened, r.explained, r.identity_error) == (0, None, None, None) for r in same)
    for rows in ([], [(1, None)], [(1, [])]):
        assert wh.whitened_embeddings(spark.createDataFrame(rows, SHAPE)).collect() == []


def test_deviations_beyond_a_long(spark):
    far = [(1, [1e9, 0.0]), (2, [-1e9, 0.0])]
    found = wh.whitened_embeddings(spark.createDataFrame(far, SHAPE), components=1).collect()
    assert [r.deviation for r in found] == [None, None]
    assert sorted(round(r.whitened, 9) for r in found) == [-1, 1]
