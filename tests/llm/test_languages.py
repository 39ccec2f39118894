"""Gradients, equal windows, held-out accuracy, and odd rows."""

import zlib

import numpy as np
from conftest import SF
from pyspark.sql import functions as F

from reelspark.llm import languages as lg
from reelspark.llm.common import table


def packed(texts):
    raw = [lg.text_bytes(t) for t in texts]
    size = np.array([len(x) for x in raw])
    return np.concatenate(raw), np.cumsum(size) - size, size


def plain(model, text):
    """Label probabilities of each byte of one window, one step after the other."""
    raw = lg.text_bytes(text)
    hidden = model.turn.shape[2]

    def read(d, order):
        h, out = np.zeros(hidden), {}
        for t in order:
            x, g = model.table[d][:, raw[t]].astype("f8"), model.turn[d].astype("f8") @ h
            z, r = (1 / (1 + np.exp(-(x[k * hidden:(k + 1) * hidden] + g[k * hidden:(k + 1) * hidden]))) for k in (0, 1))
            n = np.tanh(x[2 * hidden:] + r * (g[2 * hidden:] + model.bias[d][:, 0]))
            h = n + z * (h - n)
            out[t] = h
        return out

    ahead, back = read(0, range(len(raw))), read(1, range(len(raw) - 1, -1, -1))
    logits = np.stack([model.out[0] @ ahead[t] + model.out[1] @ back[t] + model.base[:, 0] for t in range(len(raw))])
    p = np.exp(logits)
    return p / p.sum(1, keepdims=True)


def test_batches_equal_a_plain_network():
    model = lg.BiGru.new(["a", "b", "c"], hidden=5)
    texts = ["Ein Satz, 12!", "é", "x1", "a somewhat longer text, of several words"]
    sums = model.position_sums(*packed(texts))
    for text, row in zip(texts, sums):
        want = plain(model, text)[lg.LETTER[lg.text_bytes(text)]].sum(0)
        assert np.allclose(row, want, atol=1e-4)


def test_gradients_equal_differences():
    model = lg.BiGru.new(["a", "b"], hidden=3)
    for name in ("table", "turn", "bias", "out", "base"):
        setattr(model, name, getattr(model, name).astype("f8"))
    args = (*packed(["abc d", "é1a", "zz"]), np.array([0, 1, 1]))
    _, grads = model.gradients(*args)
    rng = np.random.default_rng(0)
    for p, g in zip(model.parts(), grads):
        seen = np.argwhere(abs(g) > 1e-7)
        for at in map(tuple, rng.permutation(seen)[:6]):
            old = p[at]
            ends = []
            for step in (1e-2, -1e-2):
                p[at] = old + step
                ends.append(model.gradients(*args)[0])
            p[at] = old
            assert abs((ends[0] - ends[1]) / 2e-2 - g[at]) < 2e-3 + 0.02 * abs(g[at])


def test_every_byte_is_in_one_window():
    sizes = np.array([0, 1, lg.SPAN, lg.SPAN + 1, 1000, 0, 7])
    text, start, size = lg.windows(sizes)
    assert size.max() <= lg.SPAN and size.min() >= 1
    covered = np.concatenate([np.arange(a, a + n) for a, n in zip(start, size)])
    assert covered.tolist() == list(range(sizes.sum()))
    assert np.bincount(text, size, len(sizes)).tolist() == sizes.tolist()


def test_held_out_rows(spark):
    rows = lg.op12(spark, SF).join(table(spark, SF, "documents").select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == table(spark, SF, "documents").count()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert all(r.held_out for r in held) and sum(r.held_out for r in rows) == len(held)
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.9
    assert all(0 <= r.score <= 1 for r in rows)


def test_held_out_labels_are_not_used(spark, monkeypatch):
    docs = spark.createDataFrame([(k, "das der die und" if k % 3 else "the of and to", "de" if k % 3 else "en") for k in range(60)],
                                 "doc_id bigint, text string, lang string")
    changed = docs.withColumn("lang", F.when(lg.remainder(F.col("doc_id")) == 2, "xx").otherwise(F.col("lang")))
    one, two = lg.fitted(docs), lg.fitted(changed)
    assert one.langs == two.langs == ["de", "en"]
    assert all(np.array_equal(a, b) for a, b in zip(one.parts(), two.parts()))
    names, scores = one.label(["und die der", "of the and", "", None, "12 — 3!", "ŁÓDŹ", "the of " * 50_000])
    assert names[:5] == ["de", "en", "und", "und", "und"] and names[6] == "en" and scores[2:5] == [0, 0, 0]


def test_odd_rows(spark, odd, nothing):
    model = lg.BiGru.new(["de", "en"])
    rows = odd.withColumn("lang_pred", F.lit(1))
    got = lg.identified(rows, model)
    assert got.columns == [c for c in rows.columns if c not in ("lang_pred", "score")] + ["lang_pred", "score"]
    assert sorted(r.lang_pred for r in got.collect())[-3:] == ["und"] * 3 and got.count() == 9
    assert lg.fitted(nothing).langs == [] and lg.identified(nothing, lg.BiGru.new([])).count() == 0
    assert {r.lang_pred for r in lg.identified(odd, lg.BiGru.new([])).collect()} == {"und"}
