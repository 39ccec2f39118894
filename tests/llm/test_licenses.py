"""Templates against every block, and phrases by words."""

import random

from hypothesis import given, settings, strategies as st

from reelspark.llm import licenses as lic
from reelspark.llm.common import alnum_words


def brute(words, templates):
    out = []
    for k, (_, text) in enumerate(templates):
        t = set(text.encode().split())
        shared = len(t & set(words))
        if 5 * shared >= 4 * len(t):
            out.append((k, shared))
    return out


@given(st.lists(st.lists(st.sampled_from("abcdefgh"), min_size=1, max_size=8), min_size=1, max_size=5),
       st.lists(st.sampled_from("abcdefghxyz"), max_size=14), st.integers(0, 99))
@settings(max_examples=300, deadline=None)
def test_join_finds_what_all_pairs_find(templates, block, seed):
    named = [(f"t{k}", " ".join(t)) for k, t in enumerate(templates)]
    rng = random.Random(seed)
    known = lic.Templates(named, {c.encode(): rng.randint(0, 5) for c in "abcdefgh"})
    words = [c.encode() for c in block]
    assert sorted(known.within(words)) == brute(words, named)


@given(st.lists(st.lists(st.sampled_from("abcdefgh"), min_size=1, max_size=8), min_size=1, max_size=4),
       st.lists(st.sampled_from("abcdefghxyz"), max_size=30), st.integers(0, 99))
@settings(max_examples=300, deadline=None)
def test_runs_are_those_of_every_start(templates, text, seed):
    named = [(f"t{k}", " ".join(t)) for k, t in enumerate(templates)]
    rng = random.Random(seed)
    known = lic.Templates(named, {c.encode(): rng.randint(0, 5) for c in "abcdefgh"})
    words = [c.encode() for c in text]
    best = {}
    for k, t in enumerate(templates):
        for i in range(len(words)):
            for k2, shared in brute(words[i:i + len(t)], named):
                if k2 == k:
                    best[k] = max(shared, best.get(k, 0))
    got = {}
    for k, first, end, shared in known.runs(words):
        assert shared <= len(set(words[first:end]) & set(t.encode() for t in templates[k]))
        got[k] = max(shared, got.get(k, 0))
    assert got == best


MIT = """ * Permission is hereby granted, free of charge, to any person obtaining a copy
 * of this software and associated documentation files (the "Software"), to deal
 * in the Software without restriction, including without limitation the rights"""
BSD = """# Redistribution and use in source and binary forms, with or without
# modification, are permitted provided that the following conditions are met:
#"""
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by"""


def test_wrapped_headers(documents):
    texts = [MIT, BSD, GPL, *(x.replace("\n", "\n\n") for x in (MIT, BSD, GPL)), f"First.\n{MIT}\n{BSD}\nLast.", "free of charge"]
    rows = {r.doc_id: {n["label"] for n in r.licenses["notices"]} for r in lic.license_notices(documents(texts)).collect()}
    assert [rows[k] for k in range(8)] == [{"mit"}, {"bsd"}, {"gpl-3.0"}] * 2 + [{"mit", "bsd"}, set()]


def test_whole_texts_wrap_anywhere(documents):
    """Every template is found when its words are on lines of seven, behind and before other words."""
    def wrapped(text):
        words = f"other words stand here {text} and more of them there".split()
        return "\n".join(" ".join(words[i:i + 7]) for i in range(0, len(words), 7))

    rows = lic.license_notices(documents([wrapped(t) for _, t in lic.TEMPLATES])).collect()
    for r in rows:
        label, text = lic.TEMPLATES[r.doc_id]
        size = len(set(text.split()))
        assert any(n["label"] == label and n["shared"] == n["size"] == size for n in r.licenses["notices"])


@given(st.lists(st.sampled_from(["cc", "by", "general", "public", "license", "all", "rights", "reserved", "x"]), max_size=40))
@settings(deadline=None)
def test_phrases(words):
    got = {label: (first, last, n) for label, first, last, n in lic.phrase_places([w.encode() for w in words])}
    want = {}
    for phrase, label in lic.PHRASES.items():
        p = phrase.split()
        places = [k for k in range(len(words)) if words[k:k + len(p)] == p]
        if places:
            want[label] = (places[0], places[-1], len(places))
    assert got == want


def test_scan(documents):
    texts = ["ALL rights-reserved", "nothing", "Licensed under the Apache License, Version 2.0.", "cc\nby", "ccby"]
    rows = {r.doc_id: r.licenses for r in lic.license_notices(documents(texts)).collect()}
    assert {n["label"] for n in rows[2]["notices"]} == {"apache-2.0"} and not rows[2]["phrases"]
    assert rows[0]["phrases"][0]["label"] == "reserved" and rows[3]["phrases"][0]["label"] == "cc-by"
    assert not rows[1]["notices"] and not rows[4]["phrases"]


def test_odd_rows(odd, nothing):
    got = lic.license_notices(odd)
    assert got.columns == [*odd.columns, "licenses"]
    for r in got.collect():
        assert r.licenses["n_words"] == len(alnum_words(r.text))
    assert lic.license_notices(nothing).collect() == []
