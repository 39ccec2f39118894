"""Each stage's decisions, and the whole."""

import pytest
from conftest import SF
from test_decontamination import brute as windows
from test_jaccard import brute as components

import corpus_pipeline as c
from reelspark.llm import toxicity
from reelspark.llm.common import table, written
from reelspark.llm.personal import find_all, model


@pytest.fixture(scope="module")
def kept(spark):
    out = {"start": table(spark, SF, "documents")}
    docs = out["start"]
    for name, stage in c.STAGES:
        out[name] = docs = written(stage(spark, docs, SF))
    return {k: df.collect() for k, df in out.items()}


def texts(rows):
    return {r.doc_id: r.text for r in rows}


def test_columns_stay(kept):
    for name, _ in c.STAGES[:-1]:
        assert kept[name][0].__fields__ == kept["start"][0].__fields__


def test_toxicity(spark, kept):
    docs = table(spark, SF, "documents")
    m = toxicity.fitted(docs, table(spark, SF, "labels"))
    rows = toxicity.scored(docs, m).collect()
    stay = {r.doc_id for r in rows if r.score < m.thresholds.get(r.lang, m.threshold)}
    assert {r.doc_id for r in kept["toxicity"]} == stay


def test_jaccard(kept):
    want = {i for i, _, least in components(sorted(texts(kept["toxicity"]).items())) if i == least}
    assert {r.doc_id for r in kept["jaccard"]} == want


def test_decontamination(spark, kept):
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    sets = {tuple(w) for _, t in items for w in _runs(t)}
    before = texts(kept["jaccard"])
    assert {r.doc_id for r in kept["decontamination"]} == {
        i for i, t in before.items() if not any(tuple(w) in sets for w in _runs(t))}
    assert windows("", items)[2] == []


def _runs(text):
    from reelspark.llm.common import alnum_words

    w = alnum_words(text)
    return [w[k:k + 10] for k in range(len(w) - 9)]


def test_personal(kept):
    before, after = texts(kept["decontamination"]), texts(kept["personal"])
    assert before.keys() == after.keys()
    for i, spans in zip(before, find_all(list(before.values()), model())):
        assert (before[i] == after[i]) == (not spans)
        assert not any(s[3] for s in find_all([after[i]], model())[0])


def test_packing(kept):
    assert {r.doc_id for r in kept["packing"]} == texts(kept["personal"]).keys()


def test_run(spark, kept):
    got = c.run(spark, SF).select("doc_id", "piece", "ids_crc32").collect()
    assert sorted(map(tuple, got)) == sorted((r.doc_id, r.piece, r.ids_crc32) for r in kept["packing"])
