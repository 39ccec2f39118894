"""Repeated keys leave one row, generated names are new, and listings reach all cores."""

import hashlib

import numpy as np
from pyspark.sql import functions as F

from reelspark.operators import assets, catalog
from reelspark.plans.runs import explode_range
from reelspark.plans.spread import spread


def shuffled_rows(spark, df):
    """Rows that all exchanges of a plan wrote."""
    plan = df._jdf.queryExecution().executedPlan()
    df.collect()
    found, todo = {}, [plan]
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif node.getClass().getSimpleName() in ("ShuffleQueryStageExec", "BroadcastQueryStageExec"):
            todo.append(node.plan())
        elif node.getClass().getSimpleName() == "ShuffleExchangeExec":
            found[node.id()] = node.metrics().apply("shuffleRecordsWritten").value()
        children = node.children()
        todo += [children.apply(k) for k in range(children.size())]
    return sum(found.values())


def test_the_last_update_of_a_key_counts(spark, as_rows):
    t = spark.createDataFrame([(1, "a", 9), (2, "b", 9)], "k int, v string, other int")
    updates = spark.createDataFrame([(1, "x", 1), (1, "y", 2), (1, "a", 0), (3, "n", 1), (3, "m", 2)], "k int, v string, at int")
    got = as_rows(catalog.upsert_managed(t, updates, ["k"], ["v"], ["at"]))
    assert got == [(1, "y", 9), (2, "b", 9), (3, "m", None)]
    assert catalog.upsert_managed(t, updates, ["k"], ["v"]).count() == 3
    assert catalog.classify_changes(t.union(t), t, ["k"], ["v"]).count() == 2


def test_repeated_offsets_and_cache_rows(spark):
    t = spark.createDataFrame([("d", 1, "cam", "p/cam/x", 0.0)], "recording_date string, case_no int, camera_name string, path string, offset_seconds double")
    updates = spark.createDataFrame([("d", 1, "cam", 1.0), ("d", 1, "cam", 2.0)], "recording_date string, case_no int, camera_name string, offset_seconds double")
    assert [r.offset_seconds for r in catalog.update_offsets(t, updates).collect()] == [2.0]
    scan = spark.createDataFrame([("f", 10)], "name string, size int")
    cached = spark.createDataFrame([("f", 10, None), ("f", 10, 7)], "name string, size int, frames int")
    assert [tuple(r) for r in assets.reuse_cached(scan, cached, ["name"], "size", "frames").collect()] == [("f", 10, 7, False)]


def test_generated_names_are_new(spark):
    names = ["a.mp4"] * 4 + ["a_1.mp4", "a_3.mp4", "a_1.mp4", "b", "b", "b_1", "c_2.mp4", "c_2.mp4", "c.mp4", "c.mp4", "a_01.mp4"]
    rows = spark.createDataFrame([(f"s{k}", n) for k, n in enumerate(names)], "source_path string, destination_path string")
    got = assets.unique_names(rows).collect()
    assert len({r.unique_path for r in got}) == len(names)
    assert {r.unique_path for r in got if r.destination_path == "a.mp4"} == {"a.mp4", "a_2.mp4", "a_4.mp4", "a_5.mp4"}
    assert {r.unique_path for r in got if r.destination_path == "b"} == {"b", "b_2"}


def test_listings_reach_all_cores(spark):
    listing = spark.range(5000).select(F.concat(F.lit("/p/"), "id").alias("path"))
    tasks = spread(listing, "path").select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks >= spark.sparkContext.defaultParallelism


def test_taken_numbers_of_any_amount(spark):
    """Against a walk over the numbers: gaps, runs, numbers above and below, two names at once."""
    rng = np.random.default_rng(6)
    names = ["x.mp4"] * 60 + ["y.mp4"] * 5 + [f"x_{n}.mp4" for n in rng.permutation(90)[:50] + 1] + ["y_2.mp4", "y_10000000000.mp4", "z_1.mp4"]
    rows = spark.createDataFrame([(f"s{k}", n, k) for k, n in enumerate(names)], "source_path string, destination_path string, _rank int")
    got = assets.unique_names(rows).collect()
    assert len(got) == len({r.unique_path for r in got}) == len(names)
    for stem, count in (("x", 60), ("y", 5)):
        taken = {n for n in names if n.startswith(f"{stem}_")}
        free = [f"{stem}_{k}.mp4" for k in range(1, 200) if f"{stem}_{k}.mp4" not in taken][:count - 1]
        assert {r.unique_path for r in got if r.destination_path == f"{stem}.mp4"} == {f"{stem}.mp4", *free}


def test_long_ranges_in_blocks(spark):
    df = spark.createDataFrame([("a", 3, 12), ("b", 5, 4), ("c", 7, 7), ("d", None, 3)], "k string, lo bigint, hi bigint")
    got = sorted((r.k, r.n) for r in explode_range(df, "lo", "hi", "n", block=4).collect())
    assert got == [("a", n) for n in range(3, 13)] + [("c", 7)]
    long = spark.createDataFrame([(0, 300_000_000)], "lo bigint, hi bigint")
    assert explode_range(long, "lo", "hi", "n").agg(F.count("n"), F.max("n")).first() == (300_000_001, 300_000_000)


def test_names_of_any_size_are_numbered_in_one_shuffle_of_rows(spark, monkeypatch):
    """Against a walk over digests: large and small names, taken numbers, repeated rows; rows are shuffled once."""
    names = ["x.mp4"] * 300 + ["y.mp4"] * 40 + ["z"] * 3 + [f"x_{n}.mp4" for n in [*range(1, 90, 2), *range(120, 160), 299, 300, 345, 10**9]]
    names += ["x_3.mp4"] * 20 + [f"x_3_{n}.mp4" for n in (1, 2, 4, 7)] + ["y_2.mp4", "y_39.mp4", "y_40.mp4", "w_1"]
    table = [(f"s{k}", n, k % 3) for k, n in enumerate(names)]
    rows = spark.createDataFrame(table, "source_path string, `to.path` string, _rank int").union(
        spark.createDataFrame([(None, "x.mp4", 1), ("s", None, 1), ("t", None, 2)], "s string, d string, r int"))
    want = {}
    for name in set(names):
        stem, dot, ext = name.partition(".")
        free = (c for c in (f"{stem}_{k}{dot}{ext}" for k in range(1, 10**4)) if c not in names)
        files = sorted((f for f, n, _ in table if n == name), key=lambda f: hashlib.md5(f.encode()).hexdigest())
        for k, f in enumerate([None, *files] if name == "x.mp4" else files):
            want[f, name] = next(free) if k else name

    def check(df, **options):
        got = assets.unique_names(df, "to.path", **options)
        assert got.columns == ["source_path", "to.path", "_rank", "unique_path"]
        found = got.collect()
        assert len(found) == len(want) + 2 and {(r[0], r[1]): r[3] for r in found if r[1]} == want
        assert [r[3] for r in found if r[1] is None] == [None, None]
        return got

    check(rows)
    check(rows.union(rows).union(rows.limit(7)), distinct=True)
    monkeypatch.setattr(assets, "NAME_ROWS", 4)
    check(rows)
    check(rows.union(rows).union(rows.limit(7)), distinct=True)
    many = spark.range(20000).select(F.concat(F.lit("s"), "id").alias("source_path"), F.lit("a.mp4").alias("destination_path"))
    monkeypatch.setattr(assets, "NAME_ROWS", 1 << 17)
    assert shuffled_rows(spark, assets.unique_names(many)) < 1.1 * 20000
