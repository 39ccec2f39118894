"""Components against all pairs, hot groups included."""

import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from reelspark.llm import jaccard as j
from reelspark.llm.common import space_words
from reelspark.llm.components import connected


def grams(text):
    w = space_words(text)
    return frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows):
    """(size, component) of each (doc_id, text), from all pairs."""
    sets = [(i, grams(t)) for i, t in rows]
    up = list(range(len(sets)))

    def find(a):
        while up[a] != a:
            a = up[a]
        return a

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                up[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        least[find(k)] = min(i, least.get(find(k), i))
    return sorted((i, len(s), least[find(k)]) for k, (i, s) in enumerate(sets))


def corpus(seed, n, edits):
    """Groups of near copies of few texts, edited so that many pairs are close to the threshold, with shared passages."""
    rng = random.Random(seed)
    passage = [f"p{k}" for k in range(60)]
    bases = [[f"b{g}_{k}" for k in range(rng.randint(3, 90))] for g in range(5)]
    out = []
    for k in range(n):
        words = list(rng.choice(bases))
        for _ in range(rng.randint(0, edits)):
            words[rng.randrange(len(words))] = f"e{rng.randint(0, 30)}"
        if rng.random() < 0.3:
            words += passage
        out.append((k * 3, " ".join(words)))
    return out


@pytest.mark.parametrize("seed, n, edits", [(1, 120, 3), (2, 160, 6)])
def test_components_equal_all_pairs(spark, documents, seed, n, edits):
    rows = corpus(seed, n, edits)
    got = j.near_duplicates(documents(rows)).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got)) == brute(rows)


def test_without_passes_the_filters_find_all(spark, documents, monkeypatch):
    monkeypatch.setattr(j, "near_in_order", lambda sets, turn: sets.selectExpr("id AS a", "id AS b").limit(0))
    rows = corpus(5, 120, 4)
    got = j.near_duplicates(documents(rows)).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got)) == brute(rows)


def brute_links(rows):
    """n_links of each (doc_id, text): other classes of equal sets that link with its own, from all pairs."""
    sets = [(i, grams(t)) for i, t in rows]
    classes = {s for _, s in sets if s}
    links = {s: sum(100 * len(s & t) >= 80 * len(s | t) for t in classes) - 1 for s in classes}
    return sorted((i, links.get(s, 0)) for i, s in sets)


def near_copies(seed, n, base, edits):
    """Copies of one text, each with some words of its own, so that most pairs link and some do not."""
    rng = random.Random(seed)
    words = [f"c{k}" for k in range(base)]
    out = []
    for k in range(n):
        mine = list(words)
        for _ in range(rng.randint(1, edits)):
            mine[rng.randrange(base)] = f"n{k}_{rng.randint(0, 3)}"
        out.append((k + 10_000, " ".join(mine[:rng.randint(base - 20, base)])))
    return out


@pytest.mark.parametrize("sets, tokens", [(512, 1 << 18), (40, 9_000)])
def test_links_equal_all_pairs(spark, documents, monkeypatch, sets, tokens):
    monkeypatch.setattr(j, "BLOCK_SETS", sets)
    monkeypatch.setattr(j, "BLOCK_TOKENS", tokens)
    rows = near_copies(4, 400, 200, 5) + corpus(1, 100, 3)
    want = brute_links(rows)
    assert max(n for _, n in want) > 200
    got = j.near_duplicates(documents(rows)).select("doc_id", "n_links").collect()
    assert sorted(map(tuple, got)) == want


def test_links_of_an_id_with_several_texts(spark, documents):
    base = [f"c{k}" for k in range(60)]
    texts = [" ".join([*base[:k], "x", *base[k + 1:]]) for k in (1, 20, 59)]
    rows = [(1, texts[0]), (2, texts[1]), (2, texts[2]), (3, " ".join(base))]
    got = j.near_duplicates(documents(rows)).select("doc_id", "n_links").distinct().collect()
    assert {r.doc_id: r.n_links for r in got} == {1: 2, 2: 2, 3: 2}


@given(st.lists(st.frozensets(st.integers(0, 30)), min_size=1, max_size=8), st.lists(st.frozensets(st.integers(0, 30)), min_size=1, max_size=300))
@settings(max_examples=60, deadline=None)
def test_shared_counts(x, y):
    arrays = [[np.array(sorted(s), np.int64) for s in side] for side in (x, y)]
    assert j.shared_counts(*arrays).tolist() == [[len(a & b) for b in y] for a in x]


@given(st.integers(1, 4000), st.integers(1, 4000))
@settings(deadline=None)
def test_front_lengths(n, m):
    """Sets that link share as many front tokens as either asks for, by the counting argument."""
    if 80 * max(n, m) > 100 * min(n, m):
        return
    need = max(j.shared_least(n), j.shared_least(m))
    asked = min(j.extra(n), j.extra(m)) + 1
    for size in (n, m):
        assert size - need + asked <= j.prefix(size)
        assert asked >= j.extra(j.shared_least(size)) + 1 or asked <= need
    assert j.extra(j.shared_least(n)) <= j.extra(m)


def test_components(spark):
    chain = [(k, k + 1) for k in range(0, 60)] + [(100, 101), (101, 100), (7, 7), (200, 101)]
    got = connected(spark.createDataFrame(chain, "a bigint, b bigint")).collect()
    assert {r.id: r.component for r in got} == {**{k: 0 for k in range(61)}, 100: 100, 101: 100, 200: 100}
    assert connected(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_odd_rows(spark, odd, nothing):
    got = sorted(map(tuple, j.near_duplicates(odd).select("doc_id", "n_shingles", "component_id").collect()), key=repr)
    assert got == sorted([
        (1, 0, 1), (2, 0, 2), (3, 59_996, 3), (4, 1, 4), (4, 1, 4), (None, 1, None), (6, 0, 6), (7, 1, 4), (8, 1, 8)], key=repr)
    assert j.near_duplicates(nothing).collect() == []
    kept = j.one_of_each(odd)
    assert kept.columns == odd.columns and kept.filter("doc_id = 7").count() == 0 and kept.count() == 8
