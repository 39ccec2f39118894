"""Bucketed windows equal plain windows, whatever the bucket width."""

import random
import statistics

import pytest
from pyspark.sql import Window, functions as F

from reelspark.plans import carry as C
from reelspark.plans.quantiles import exact_quantiles


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(3)
    # one group holds most rows; positions have holes
    out = []
    for key, n in (("hot", 400), ("a", 30), ("b", 1)):
        for pos in rng.sample(range(n * 3), n):
            out.append((key, pos, None if rng.random() < 0.4 else rng.randint(-50, 50)))
    return spark.createDataFrame(out, "g string, pos bigint, v bigint").cache()


@pytest.mark.parametrize("width", [1, 7, 64, 100000])
def test_bucketed_windows(data, as_rows, width):
    w = Window.partitionBy("g").orderBy("pos")
    keys, order = ["g"], ["pos"]
    plain = data.select("*", F.lag("v").over(w).alias("x"))
    assert as_rows(C.with_previous(data, keys, order, ["v"], width)) == as_rows(plain)
    plain = data.select("*", F.lead("pos").over(w).alias("x"))
    assert as_rows(C.with_next(data, keys, order, ["pos"], width)) == as_rows(plain)
    filled = data.withColumn("v", F.coalesce("v", F.lit(0)))
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    plain = filled.select("*", F.sum("v").over(upto).alias("x"))
    assert as_rows(C.with_running_sum(filled, keys, order, F.col("v"), "x", width)) == as_rows(plain)
    earlier = w.rowsBetween(Window.unboundedPreceding, -1)
    plain = filled.select("*", F.max("v").over(earlier).alias("x"))
    assert as_rows(C.with_earlier_max(filled, keys, order, F.col("v"), "x", width)) == as_rows(plain)
    near = C.with_known_neighbours(data, keys, "pos", ["v"], width).select("g", "pos", "_lo_v.value", "_hi_v.value")
    plain = data.select(
        "g", "pos", F.last("v", True).over(upto), F.first("v", True).over(w.rowsBetween(0, Window.unboundedFollowing)))
    assert as_rows(near) == as_rows(plain)


@pytest.mark.parametrize("buckets", [16, 4096])
def test_group_rank(data, as_rows, buckets):
    digest = F.md5(F.col("pos").cast("string"))
    w = Window.partitionBy("g").orderBy(digest, "pos")
    plain = data.select("*", (F.row_number().over(w) - 1).cast("long").alias("x"))
    assert as_rows(C.with_group_rank(data, ["g"], ["pos"], digest, "x", buckets=buckets)) == as_rows(plain)


def test_exact_quantiles(spark, data):
    got = {r["g"]: r for r in exact_quantiles(data, ["g"], "v", {"q1": 0.25, "m": 0.5, "q9": 0.9}).collect()}
    want = data.groupBy("g").agg(*[
        F.percentile("v", F.lit(p)).alias(n) for n, p in (("q1", 0.25), ("m", 0.5), ("q9", 0.9))]).collect()
    for r in want:
        if r["m"] is not None:
            assert tuple(got[r["g"]]) == pytest.approx(tuple(r))
    values = [float(r["v"]) for r in data.filter("g = 'hot' AND v IS NOT NULL").collect()]
    assert got["hot"]["m"] == statistics.median(values)
