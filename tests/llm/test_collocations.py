"""Counts and scores against brute force, collisions, and odd rows."""

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF
from pyspark.sql import functions as F

from reelspark.llm import collocations as c
from reelspark.llm.common import table

LOWER = str.maketrans({chr(k): chr(k + 32) for k in range(65, 91)})


def brute(rows, least, top=2000, longest=4):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, longest + 1):
                for k in range(len(words) - size + 1):
                    f[lang][tuple(words[k:k + size])] += 1
    out = []
    for lang, counts in f.items():
        some = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        gone = {q[i:i + s] for q, a in some.items() for s in range(2, len(q)) for i in range(len(q) - s + 1)
                if 100 * a >= 80 * counts[q[i:i + s]]}
        found = []
        for p, a in some.items():
            if p in gone:
                continue
            score, k = min((2000000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def got(df):
    return sorted(tuple(r)[:8] for r in df.collect())


def test_query_equals_brute_force(spark):
    rows = [(r.text, r.lang) for r in table(spark, SF, "documents").select("text", "lang").collect()]
    assert got(c.op13(spark, SF)) == brute(rows, 30) != []


ODD = [
    ("New York City, New York city. new york", "en"), ("new york city! New\tYork City", None), (None, "en"), ("", None),
    (" . , ; \n\r", "en"), ("a a a a a a a a", "fr"), ("a\x0bb\x0ca b\ra b", "fr"), ("É é É é x É é", "en"), ("  \x1c x \x1c x", "en"),
    ("ab b", ""), ("ab b ab b", ""),
]


@pytest.mark.parametrize("chunk", [1 << 20, 4])
def test_odd_texts_and_small_chunks(spark, chunk):
    """Pieces, overlaps, repeated rows, null languages; n-grams across the borders of chunks."""
    rows = ODD * 2
    docs = spark.createDataFrame([(k, t, x) for k, (t, x) in enumerate(rows)], "doc_id bigint, text string, lang string")
    assert got(c.collocations(docs.coalesce(1), least=2, chunk=chunk)) == brute(rows, 2)
    assert got(c.collocations(docs, least=2, top=1, chunk=chunk)) == brute(rows, 2, top=1)


def test_segments_cut_between_words(monkeypatch):
    texts = [t for t, _ in ODD if t] + ["a very-very-long-word-that-passes-all-segments b, c", "xyz" * 50]
    known = c.WordIds()
    whole = [c.token_ids(t, known).tolist() for t in texts]
    monkeypatch.setattr(c, "SEGMENT", 5)
    assert [c.token_ids(t, known).tolist() for t in texts] == whole


def test_equal_fingerprints_of_different_phrases(spark, monkeypatch):
    """Where all fingerprints collide the counts are still those of the words."""
    monkeypatch.setattr(c.Powers, "named", staticmethod(lambda prints, n, lang: prints & np.uint64(1)))
    place, starts = c._grouped(np.zeros(6, np.uint64), np.arange(6), np.array([1, 2, 1, 2, 1, 3, 3, 0]), 2)
    assert sorted(np.diff(np.append(starts, 6)).tolist()) == [1, 1, 2, 2]
    ids = np.array([1, 2, 1, 2, 1, 3, 3, 0])
    groups = [[tuple(ids[p:p + 2]) for p in g] for g in np.split(place, starts[1:])]
    assert all(len(set(g)) == 1 for g in groups)


def test_fingerprints_follow_their_definition():
    """The differences of prefix polynomials are the polynomials of the n-grams."""
    rng = np.random.default_rng(2)
    hashes = rng.integers(0, 1 << 63, 50).astype(np.uint64)
    powers = c.Powers(60)
    for n in (1, 2, 3, 4):
        want = [sum(int(h) * pow(c.BASE, n - 1 - t, 1 << 64) for t, h in enumerate(hashes[k:k + n])) % (1 << 64) for k in range(51 - n)]
        assert powers.grams(hashes, n, 9).tolist() == c.Powers.named(np.array(want, np.uint64), n, 9).tolist()


def test_no_frequent_one_is_missed(spark):
    prints = spark.range(20_000).select(F.xxhash64("id").alias("print"))
    found = c.frequent_filter(prints).value
    every = np.array([r[0] for r in prints.collect()]).view(np.uint64)
    assert found.has(every).all()
    assert found.has(np.random.default_rng(1).integers(0, 1 << 63, 20_000).astype(np.uint64)).mean() < 0.05


def test_very_long_words_and_odd_rows(spark, odd, nothing):
    assert got(c.collocations(nothing, least=1)) == []
    rows = [(r.text, r.lang) for r in odd.select("text", "lang").collect()]
    assert got(c.collocations(odd.withColumn("text", F.when(F.col("doc_id") == 3, F.lit(None)).otherwise(F.col("text"))), least=2)) == brute(
        [(None if t and len(t) > 400_000 else t, x) for t, x in rows], 2)
    assert c.collocations(odd, least=3).count() >= 1  # one two three, three times over


def test_seen_in_the_first_document(spark):
    docs = spark.createDataFrame([(k, "red car" if k % 2 else "blue car", "en") for k in range(9, 0, -1)], "doc_id bigint, text string, lang string")
    assert {r.phrase: r.seen_doc for r in c.collocations(docs, least=2).collect()} == {"red car": 1, "blue car": 2}


def test_texts_are_read_once_and_phrases_not_sent_by_chunk(spark, monkeypatch):
    """One pass splits the texts; later ones read word numbers, and no chunk sends the text of a frequent phrase."""
    docs = spark.createDataFrame([(k, t, x) for k, (t, x) in enumerate(ODD * 2)], "doc_id bigint, text string, lang string")
    calls, plain = [], type(docs).mapInArrow

    def spied(df, func, schema, *more, **named):
        calls.append((df.columns, schema))
        return plain(df, func, schema, *more, **named)

    monkeypatch.setattr(type(docs), "mapInArrow", spied)
    assert got(c.collocations(docs, least=2, chunk=4)) == brute(ODD * 2, 2)
    assert sum("text" in columns for columns, _ in calls) == 1
    assert not [schema for _, schema in calls if "phrase" in str(schema)]


def test_words_of_one_name_get_others(spark, monkeypatch):
    """Names that two words share are found, also between languages, and given anew."""
    docs = spark.createDataFrame([(k, t, x) for k, (t, x) in enumerate(ODD * 2)], "doc_id bigint, text string, lang string")
    plain, seeds = c.word_chunks, []

    def colliding(texts, longest, chunk, seed):
        seeds.append(seed)
        chunks = plain(texts, longest, chunk, seed)
        return chunks if seed else chunks.withColumn("names", F.transform("names", lambda name: name.bitwiseAND(3)))

    monkeypatch.setattr(c, "word_chunks", colliding)
    assert got(c.collocations(docs, least=2)) == brute(ODD * 2, 2)
    assert seeds == [0, 1]
    shared = [("one", "en"), ("one", "fr"), ("two", "en")]
    words = c.named_words(spark.createDataFrame([(1, t, x) for t, x in shared], "doc_id bigint, text string, lang string"), 4, 8)[1]
    assert sorted((r.word, r.lang) for r in words.collect()) == sorted(shared)
    assert len({r.name for r in words.collect()}) == 3


def test_word_numbers_come_back():
    for ids in (np.arange(300_000), np.array([0]), np.array([], np.int64)):
        assert c.unpacked(pa.py_buffer(c.packed(ids)), len(ids)).tolist() == ids.tolist()
