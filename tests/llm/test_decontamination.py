"""Occurrences against a scan of every position."""

import random

import pytest

from reelspark.llm import decontamination as d
from reelspark.llm.common import alnum_words


def brute(text, items, size=10):
    words = alnum_words(text)
    hit, found = set(), set()
    for i, item in items:
        w = alnum_words(item)
        if not w:
            continue
        n = min(size, len(w))
        for window in {tuple(w[k:k + n]) for k in range(len(w) - n + 1)}:
            for at in range(len(words) - n + 1):
                if tuple(words[at:at + n]) == window:
                    hit |= set(range(at, at + n))
                    found |= {i} - {None}
    return len(words), hit, sorted(found)


@pytest.fixture
def bench(spark):
    def make(items):
        return spark.createDataFrame(items, "item_id bigint, text string, window string, items int")
    return lambda rows: make([(i, t, None, None) for i, t in rows])


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("block", [100_000, 7])
def test_equals_a_scan_of_every_place(spark, documents, bench, seed, block):
    rng = random.Random(seed)

    def text(n):
        return " ".join(rng.choice(("a", "B", "c", "Ä")) for _ in range(n))

    items = [(k, text(rng.choice((1, 3, 9, 10, 11, 14)))) for k in range(8)] + [(90, None), (91, ""), (None, "a Ä"), (92, "- -")]
    items += [(93, items[3][1])]
    texts = [text(rng.randint(0, 200)) for _ in range(20)]
    texts += [items[5][1].upper().replace(" ", ", ") + "!", f"x {items[4][1]} {items[4][1]} y"]
    got = d.contamination(documents(texts), bench(items), block=block).collect()
    for r in got:
        c = r.contamination
        hit = {k for s in c["spans"] for k in range(s["first"], s["end"])}
        assert (c["n_words"], hit, list(c["items"])) == brute(r.text, items)


def test_items_without_id_hit(documents, bench):
    c = d.contamination(documents(["zz a b c yy"]), bench([(None, "a b c")])).first().contamination
    assert [tuple(s) for s in c.spans] == [(1, 4)] and list(c["items"]) == []
    assert d.drop_contaminated(documents(["zz a b c yy"]), bench([(None, "a b c")])).collect() == []


def test_common_texts_in_blocks(documents, bench):
    """Copies of one text all get the hits of every block."""
    got = d.contamination(documents(["x a b y c d"] * 50 + ["e"]), bench([(1, "a b"), (2, "c d"), (3, "e")]), block=1)
    assert sorted(list(r.contamination["items"]) for r in got.collect()) == [[1, 2]] * 50 + [[3]]


def test_search_skips():
    m = d.WuManber({tuple(b"abcdefghij"[k:k + 1] for k in range(10)): [1]})
    words = [b"z"] * 50 + [b"abcdefghij"[k:k + 1] for k in range(10)] + [b"z"] * 3
    assert list(m.find(words)) == [(50, [1])]
    assert m.shift[(b"a", b"b")] == 8 and m.shift[(b"i", b"j")] == 0


def test_odd_rows(odd, nothing, bench, documents):
    items = bench([(1, "one two three"), (2, "w59998 w59999")])
    got = d.contamination(odd, items)
    assert got.columns == [*odd.columns, "contamination"]
    hits = {r.doc_id: list(r.contamination["items"]) for r in got.collect()}
    assert hits == {1: [], 2: [], 3: [2], 4: [1], None: [], 6: [], 7: [1], 8: []}
    several = d.contamination(odd, items, block=1)
    assert several.columns == got.columns and sorted(map(repr, several.collect())) == sorted(map(repr, got.collect()))
    left = d.drop_contaminated(odd, items)
    assert {r._contamination for r in left.collect()} == {5}
    assert left.columns == odd.columns and left.count() == 5
    assert d.drop_contaminated(nothing, items).collect() == []
    assert d.contamination(odd, bench([])).filter("size(contamination.items) > 0").count() == 0
