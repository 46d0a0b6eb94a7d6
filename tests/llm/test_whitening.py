"""Whitening against a full eigenvalue decomposition."""

import numpy as np
import pytest

from sightline.llm import whitening

TABLE = "vec_id long, embedding array<float>, x string, n int"


def _table(spark, rows):
    return spark.createDataFrame([(i, v, "c", 1) for i, v in rows], TABLE)


def _symmetric(values, seed=0):
    turned = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))[0]
    out = (turned * values) @ turned.T
    return (out + out.T) / 2


@pytest.mark.parametrize("seed", range(6))
def test_inertia(seed):
    rng = np.random.default_rng(seed)
    values = rng.standard_normal(12)
    values[:seed] = 0
    assert whitening.inertia(_symmetric(values, seed)) == ((values > 0).sum(), seed, (values < 0).sum())
    assert whitening.inertia(np.array([[0.0, 1.0], [1.0, 0.0]])) == (1, 0, 1)
    assert whitening.inertia(np.zeros((3, 3))) == (0, 3, 0)


@pytest.mark.parametrize(
    "values",
    [
        [1.0],
        [3.0, 1.0],
        np.geomspace(1e6, 1e-3, 20),
        np.linspace(1, 2, 40),
        [5, 4, 3, 2, 2 - 1e-7, 1],
        [9, 8, 7, 1 + 1e-11, 1, 0.5, 0, 0],
    ],
)
def test_components_are_those_of_the_full_decomposition(values):
    matrix = _symmetric(np.array(values, dtype=float), 3)
    got, vectors = whitening.leading_components(matrix, 4)
    all_values, all_vectors = np.linalg.eigh(matrix)
    k = min(4, len(values))
    assert np.allclose(got, all_values[::-1][:k], rtol=1e-13, atol=1e-14 * all_values[-1])
    assert np.allclose(matrix @ vectors, vectors * got, atol=1e-13 * all_values[-1])
    assert np.allclose(vectors.T @ vectors, np.eye(k), atol=1e-13)
    if min(-np.diff(sorted(values, reverse=True)[: k + 1]), default=1) > 1e-3:
        assert np.allclose(np.abs((all_vectors[:, ::-1][:, :k] * vectors).sum(axis=0)), 1, atol=1e-12)


def test_equal_values_and_none():
    got, vectors = whitening.leading_components(np.eye(9) * 4, 4)
    assert np.allclose(got, 4) and np.allclose(vectors.T @ vectors, np.eye(4))
    assert len(whitening.leading_components(np.zeros((5, 5)), 4)[0]) == 0
    one = np.outer([1.0, 2, 2], [1.0, 2, 2])
    assert np.allclose(whitening.leading_components(one, 4)[0], [9])


def test_intervals_hold_what_inertia_counts():
    values = np.linspace(1, 2, 30)
    found = whitening.intervals(_symmetric(values), 12, 1e-12, most=5)
    assert sum(c for *_, c in found) >= 12
    for low, high, count in found:
        assert ((values > low) & (values <= high)).sum() == count <= 6


def test_embeddings(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(v) for v in rng.standard_normal(6) * [4, 3, 2, 1.5, 1, 0.5]]) for i in range(200)]
    rows += [(300 + i, rows[0][1]) for i in range(90)] + [(5, rows[6][1]), (5, rows[6][1]), (None, rows[9][1])]
    bad = [(400, None), (401, [1.0] * 5 + [None]), (402, [float("nan")] * 6), (403, [float("-inf")] + [0.0] * 5)]
    got = whitening.whiten_embeddings(_table(spark, rows + bad).repartition(4)).toPandas()
    x = np.floor(256 * np.array([v for _, v in rows], dtype="float32").astype(float)).astype("int64")
    distinct = np.unique(x, axis=0)
    n, sums = len(distinct), distinct.sum(axis=0)
    centred = distinct - sums / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    assert len(got) == 4 * len(rows) and set(got.n) == {n} == {200}
    deviation = ((n * x - sums) ** 2).sum(axis=1)
    assert sorted(got.deviation) == sorted(np.repeat(deviation, 4))
    for component in range(4):
        own = got[got.component == component + 1]
        assert np.allclose(own.explained, values[component] / values.sum(), rtol=1e-9)
        want = (x - sums / n) @ vectors[:, component] / np.sqrt(values[component])
        for sign in (1, -1):
            if np.allclose(sorted(sign * want), sorted(own.whitened), atol=1e-9):
                break
        else:
            raise AssertionError(component)
    assert got.identity_error.nunique() == 1 and got.identity_error[0] < 1e-10


def test_few_and_odd_vectors(spark):
    assert whitening.whiten_embeddings(_table(spark, [])).count() == 0
    assert whitening.whiten_embeddings(_table(spark, [(1, None), (2, [])])).count() == 0
    assert whitening.whiten_embeddings(_table(spark, [(1, [1.0, 2.0])] * 3)).count() == 0
    got = whitening.whiten_embeddings(_table(spark, [(1, [1.0]), (2, [1.0, 1.0]), (3, [-0.0, 0.0])])).collect()
    assert {r.component for r in got} == {1, 2} and {r.vec_id for r in got} == {1, 2, 3}
    assert {r.deviation for r in got if r.vec_id == 2} == {(3 * 256 - 512) ** 2 + (3 * 256 - 256) ** 2}


def test_deviation_beyond_a_long(spark):
    far = [(i, [v, 1.0]) for i, v in enumerate([1e30, -1e30, 0.0])]
    got = whitening.whiten_embeddings(_table(spark, far)).toPandas()
    assert set(got[got.vec_id < 2].deviation.isna()) == {True}
    assert whitening._deviation(np.array([[2**40]]), 3, np.array([0], dtype=object)) == [None]
    assert whitening._deviation(np.array([[2**30]]), 2, np.array([1], dtype=object)) == [(2**31 - 1) ** 2]
