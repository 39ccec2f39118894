"""Components, deviations and whitened rows against numpy; odd vectors."""

import numpy as np
import pytest
from conftest import SF
from pyspark.sql import functions as F

from reelspark.llm import whitening as w
from reelspark.llm.common import table


def numbers(vectors):
    return np.floor(np.asarray(vectors, "f8") * w.SCALE).astype("i8") + w.SHIFT


def frame(spark, vectors):
    return spark.createDataFrame([(k, v) for k, v in enumerate(vectors)], "vec_id bigint, embedding array<float>")


def exact(x):
    n, s = len(x), x.sum(0)
    y = (n * x - s) / n
    e, q = np.linalg.eigh(y.T @ y / n)
    return n, s, y, e[::-1], q[:, ::-1]


def test_query_equals_numpy(spark):
    rows = table(spark, SF, "embeddings").orderBy("vec_id").collect()
    n, s, y, e, q = exact(numbers([r.embedding for r in rows]))
    got = w.op11(spark, SF).orderBy("vec_id", "component").toPandas()
    assert len(got) == n * 32 and (got["n"] == n).all()
    x = numbers([r.embedding for r in rows])
    assert got.deviation.to_numpy().reshape(n, 32)[:, 0].tolist() == ((n * x - s) ** 2).sum(1).tolist()
    mine = got.whitened.to_numpy().reshape(n, 32)
    want = y @ q[:, :32] / np.sqrt(e[:32])
    assert abs(mine * np.sign((mine * want).sum(0)) - want).max() < 1e-8
    assert np.allclose(got.explained[:32], e[:32] / e.sum(), rtol=1e-10)
    assert got.identity_error.nunique() == 1 and got.identity_error.iloc[0] < 1e-9


def test_more_dimensions_than_the_block(spark):
    """Only a part of the spectrum is iterated; two eigenvalues nearly meet at the border."""
    rng = np.random.default_rng(4)
    vectors = (rng.normal(size=(400, 90)) * np.concatenate([np.linspace(3, 1, 4), np.full(86, 0.3)])).astype("f4")
    model, rows = w.fit(frame(spark, vectors.tolist()), components=4)
    n, s, y, e, q = exact(numbers(vectors))
    assert np.allclose(model.values, e[:4], rtol=1e-12) and model.residual < w.CERTAIN
    assert np.allclose(abs((model.vectors * q[:, :4]).sum(0)), 1, atol=1e-10)
    assert model.beyond <= e[4] * (1 + 1e-9) and model.passes > 3
    assert rows.count() == 400


def test_filter_damps_the_unwanted(spark):
    """The filter's polynomial is the scaled Chebyshev polynomial, on a diagonal covariance."""
    values = np.array([9.0, 4.0, 1.0, 0.5, 0.0])
    passes = w._Passes.__new__(w._Passes)
    passes.times = lambda q: values[:, None] * q
    out = passes.filtered(np.eye(5), 0.0, 2.0, 9.0, 6)
    cheb = np.polynomial.chebyshev.Chebyshev.basis(6)
    assert np.allclose(np.diag(out), cheb(values - 1) / cheb(8.0))


def test_odd_vectors(spark):
    rng = np.random.default_rng(1)
    good = rng.normal(size=(30, 3)).round(3).tolist()
    odd = [None, [], [1.0, None, 2.0], [1.0, float("nan"), 2.0], [1.0, float("inf"), 0.0], [1.0, 2.0], good[0]]
    rows = spark.createDataFrame(
        [(k, v, "x", 1.0) for k, v in enumerate(good + odd)], "vec_id bigint, embedding array<double>, deviation string, whitened double")
    model, sound = w.fit(rows, components=32)
    n, s, y, e, q = exact(numbers(good + [good[0]]))
    assert model.n == n == 31 and np.allclose(model.values, e)
    got = w.whitened(sound, model)
    assert got.columns == ["vec_id", "embedding", "deviation", "whitened"] and got.count() == 31
    assert len({tuple(r.whitened) for r in got.filter("vec_id in (0, 36)").collect()}) == 1


@pytest.mark.parametrize("vectors", [[], [None], [[]]])
def test_nothing_to_fit(spark, vectors):
    assert w.fit(frame(spark, vectors))[0] is None


def test_without_variance(spark):
    """One direction only: the other components are undefined; one vector: all are."""
    model, rows = w.fit(frame(spark, [[float(k), 1.0, 2.0] for k in range(5)]))
    assert model.sound.tolist() == [True, False, False] and model.identity_error < 1e-9
    assert [r.whitened[1:] for r in w.whitened(rows, model).collect()] == [[None, None]] * 5
    model, rows = w.fit(frame(spark, [[1.0, 2.0]]))
    assert [r.whitened for r in w.whitened(rows, model).collect()] == [[None, None]]
    assert [r.deviation for r in w.whitened(rows, model).collect()] == [0]
