"""Held-out accuracy, calibration, and odd rows."""

import zlib

import numpy as np
from conftest import SF
from pyspark.sql import functions as F

from reelspark.llm import toxicity as t
from reelspark.llm.common import table


def labelled(spark, n=1000):
    """Every third document holds one of two rude words with varied endings."""
    rng = np.random.default_rng(1)
    rows = []
    for k in range(n):
        words = [f"w{x}" for x in rng.integers(0, 60, 40)]
        if k % 3 == 0:
            words[int(rng.integers(0, 40))] = ("blargh", "zounds")[k % 2] + ("", "en", "s")[k % 5 % 3]
        rows.append((k, " ".join(words), "en" if k % 2 else "de", int(k % 3 == 0)))
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, toxic int")


def test_held_out_rows_are_told_apart(spark):
    docs = labelled(spark)
    model = t.fitted(docs.select("doc_id", "text", "lang"), docs.select("doc_id", "toxic"))
    rows = t.scored(docs, model).select("doc_id", "toxic", "score").collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len(held) > 50
    assert np.mean([(r.score >= 0.5) == r.toxic for r in held]) > 0.9
    assert all(0 <= r.score <= 1 for r in rows)


def test_held_out_labels_are_not_used(spark):
    docs = labelled(spark, 120)
    labels = docs.select("doc_id", "toxic")
    changed = labels.withColumn("toxic", F.when(t.remainder(F.col("doc_id")) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = (t.fitted(docs, x) for x in (labels, changed))
    assert np.array_equal(one.table, two.table) and one.thresholds == two.thresholds


def test_parts_of_a_long_text_give_its_score(monkeypatch):
    model = t.Cnn.new()
    memo = t.WordIds()
    texts = [t.word_ids(" ".join(f"x{k * 7 % 1000}" for k in range(n)), memo) for n in (0, 1, 2, 5000, 333)]
    whole = model.scores(texts)
    monkeypatch.setattr(t, "PART", 100)
    assert np.allclose(model.scores(texts), whole, atol=1e-6)
    assert np.allclose([model.scores([x])[0] for x in texts], whole, atol=1e-6)


def test_gradients_lower_the_loss():
    memo = t.WordIds()
    texts = [t.word_ids("good day" if k % 2 else "bad day", memo) for k in range(40)]
    y = np.array([k % 2 for k in range(40)])
    model = t.Cnn.new()
    model.fit(texts, y, np.ones(40), epochs=5)
    s = 1 / (1 + np.exp(-model.logits(texts)))
    assert s[y == 1].min() > 0.9 and s[y == 0].max() < 0.1


def test_best_threshold_separates():
    s, y = np.array([0.1, 0.2, 0.6, 0.9]), np.array([0, 0, 1, 1])
    assert abs(t._best_threshold(s, y, np.ones(4), 0.5) - 0.4) < 1e-9
    assert t._best_threshold(s, np.zeros(4), np.ones(4), 0.3) == 0.3


def test_all_labelled_rows_calibrate(spark, monkeypatch):
    """A language whose toxic rows hardly reach the sample of the fit, and rows too long for it, set the thresholds."""
    monkeypatch.setattr(t, "FIT_ROWS", {1: 60, 0: 120})
    docs = labelled(spark, 1500).withColumn("lang", F.when(F.col("doc_id") < 1300, "en").otherwise("fr"))
    filler = " ".join(f"w{k % 60}" for k in range(t.FIT_WORDS + 100))
    docs = docs.withColumn("text", F.when(F.col("lang") == "fr", F.concat("text", F.lit(" " + filler))).otherwise(F.col("text")))
    labels = docs.select("doc_id", "toxic")
    monkeypatch.setattr(t, "LEAST_TOXIC", 5)
    seen = docs.filter((t.remainder(F.col("doc_id")) == 1) & (F.col("toxic") == 1)).groupBy("lang").count().collect()
    assert min(r["count"] for r in seen) >= 5 and len(seen) == 2
    model = t.fitted(docs.select("doc_id", "text", "lang"), labels)
    assert set(model.thresholds) == {"en", "fr"}


def test_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (3, None), (4, 1), (4, 0)], "doc_id bigint, toxic int")
    model = t.fitted(odd, labels)
    rows = t.scored(odd, model).select("doc_id", "text", "score").collect()
    assert len(rows) == 9 and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if not (r.text or "").strip()}) == 1
    assert t.drop_toxic(nothing, labels.limit(0)).collect() == []
    kept = t.drop_toxic(odd, labels)
    assert kept.columns == odd.columns and {r._score for r in kept.collect()} <= {5}


def test_query_covers_all(spark):
    docs = table(spark, SF, "documents")
    assert t.op1(spark, SF).select("doc_id").distinct().count() == docs.count()
