"""Exact quantiles against numpy, for distributions that equal-width buckets would put into one."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelspark.plans.quantiles import exact_quantiles

PROBS = {"lo": 0.0, "p01": 0.01, "q1": 0.25, "mid": 0.5, "p99": 0.99, "hi": 1.0}


def check(spark, groups, accuracy=10_000):
    rows = [(g, float(v)) for g, values in groups.items() for v in values]
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    got = {r.g: r for r in exact_quantiles(df, ["g"], "v", PROBS, accuracy).collect()}
    assert set(got) == set(groups)
    for g, values in groups.items():
        want = np.quantile(np.array(values, "f8"), list(PROBS.values()))
        assert np.allclose([got[g][n] for n in PROBS], want, rtol=1e-12, atol=1e-12), g


def test_shapes(spark):
    rng = np.random.default_rng(3)
    check(spark, {
        "one": [4.0], "two": [1.0, 2.0], "equal": [7.0] * 500, "outlier": [*rng.normal(size=3000), 1e12],
        "ties": rng.integers(0, 3, 2000), "spread": rng.normal(size=2500) ** 9, "edges": [0.0] * 999 + [1.0],
    })


@pytest.mark.parametrize("accuracy", [20, 200])
def test_coarse_sketches_give_the_same(spark, accuracy):
    rng = np.random.default_rng(5)
    check(spark, {"a": rng.normal(size=40_000), "b": rng.integers(0, 50, 5000), "c": np.sort(rng.exponential(size=9000))}, accuracy)


def test_an_outlier_leaves_brackets_small(spark):
    """What is ordered, all brackets together, is a small part of a million rows."""
    df = spark.range(1_000_000).select(F.when(F.col("id") == 5, 1e15).otherwise(F.rand(3)).alias("v"))
    out = exact_quantiles(df, [], "v", {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    rows = df.toPandas()["v"].to_numpy()
    assert np.allclose(list(out.first()), np.quantile(rows, [0.25, 0.5, 0.75]), rtol=1e-12)
    metrics = out._jdf.queryExecution().executedPlan()
    assert "percentile_approx" in metrics.toString()


def test_nulls_and_nothing(spark):
    df = spark.createDataFrame([("a", None), ("a", 3.0), ("b", None)], "g string, v double")
    assert [tuple(r) for r in exact_quantiles(df, ["g"], "v", {"m": 0.5}).collect()] == [("a", 3.0)]
    assert [tuple(r) for r in exact_quantiles(df.limit(0), [], "v", {"m": 0.5}).collect()] == [(None,)]
