"""The curve, equal counts, and pruning."""

import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from reelspark.llm import sharding as s


@pytest.mark.parametrize("n, bits", [(2, 4), (3, 3), (4, 2)])
def test_curve_visits_each_cell_by_single_steps(spark, n, bits):
    size = 1 << bits
    cells = spark.range(size**n).select(*[(F.floor(F.col("id") / size**k) % size).alias(f"x{k}") for k in range(n)])
    rows = cells.withColumn("h", s.hilbert_index([F.col(f"x{k}") for k in range(n)], bits)).orderBy("h").collect()
    assert [r.h for r in rows] == list(range(size**n))
    for a, b in zip(rows, rows[1:]):
        assert sum(abs(a[k] - b[k]) for k in range(n)) == 1


def check(rows, n, shards):
    counts = Counter(r.shard for r in rows)
    assert len(rows) == n and max(counts.values()) - min(counts.get(k, 0) for k in range(shards)) <= 1
    assert {(r.shard, r.slot) for r in rows} == {(k, j) for k in counts for j in range(counts[k])}


@pytest.mark.parametrize("n", [1, 23, 24, 25, 500])
def test_counts(documents, monkeypatch, n):
    monkeypatch.setattr(s, "ORDERED", 10)
    docs = documents(["x" * (k * k % 300) if k % 3 else "same" for k in range(n)])
    check(s.sharded(s.measured(docs)).collect(), n, s.SHARDS)


def test_manifest_skips_shards(spark, documents):
    docs = documents(["x" * (k * 37 % 5000) for k in range(600)]).withColumn("source", F.concat(F.lit("s"), F.col("doc_id") % 40))
    rows = s.sharded(s.measured(docs)).cache()
    shards = s.manifest(rows)
    assert shards.agg(F.sum("rows")).first()[0] == 600
    level = rows.filter("source = 's7'").select("level_source").first()[0]
    hit = {r.shard for r in s.shards_for(shards, source=level, size=6).collect()}
    assert {r.shard for r in rows.filter(f"level_source = {level} AND level_size = 6").collect()} <= hit and len(hit) < 12


def test_odd_rows(odd, nothing):
    rows = s.sharded(s.measured(odd)).collect()
    check(rows, 9, s.SHARDS)
    assert {(r._bucket, r._n, r._k, r._rank) for r in rows} == {(5, 5, 5, 5)}
    for r in rows:
        text = (r.text or "").encode()
        assert r["size"] == len(text) + 8 and r.text_crc32 == zlib.crc32(text)
    assert s.sharded(s.measured(nothing)).collect() == []


def test_no_python_in_the_plan(documents):
    plan = s.sharded(s.measured(documents(["a"])))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
