"""License scans: fixed phrases, and an exact set-similarity join of text blocks with license templates.

A block is a line, or any run of as many words as the template has, wherever lines break."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from reelspark.llm.common import ALNUM_WORDS, query, table

#: Phrases and their labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
#: Notices and whole license texts by label. A block contains one if it has THRESHOLD of its distinct words.
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    ("gpl-3.0", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    ("cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("proprietary", "all rights reserved no part of this publication may be reproduced without permission"),
    ("apache-2.0",
     "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license "
     "you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or "
     "agreed to in writing software distributed under the license is distributed on an as is basis without warranties or "
     "conditions of any kind either express or implied see the license for the specific language governing permissions and "
     "limitations under the license"),
    ("mit",
     "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation "
     "files the software to deal in the software without restriction including without limitation the rights to use copy modify "
     "merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is "
     "furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be "
     "included in all copies or substantial portions of the software the software is provided as is without warranty of any kind "
     "express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and "
     "noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other liability "
     "whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or "
     "other dealings in the software"),
    ("bsd",
     "redistribution and use in source and binary forms with or without modification are permitted provided that the following "
     "conditions are met redistributions of source code must retain the above copyright notice this list of conditions and the "
     "following disclaimer redistributions in binary form must reproduce the above copyright notice this list of conditions and "
     "the following disclaimer in the documentation and or other materials provided with the distribution"),
    ("isc",
     "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
     "provided that the above copyright notice and this permission notice appear in all copies"),
    ("gpl-3.0",
     "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license "
     "as published by the free software foundation either version 3 of the license or at your option any later version this "
     "program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of "
     "merchantability or fitness for a particular purpose see the gnu general public license for more details"),
)
THRESHOLD = (4, 5)
FOUND = (
    "struct<n_words:bigint,phrases:array<struct<label:string,first:bigint,last:bigint,places:bigint>>,"
    "notices:array<struct<label:string,first:bigint,end:bigint,shared:bigint,size:bigint>>>"
)

LINES = bytes(0x0A if b == 0x0A else c for b, c in enumerate(ALNUM_WORDS))


def blocks(text: str | None) -> list[list[bytes]]:
    """Words of each line."""
    lines = (text or "").encode("utf-8", "surrogatepass").translate(LINES).split(b"\n")
    return [line.split() for line in lines]


def needed(size: int) -> int:
    """Words of a template of `size` distinct words that a block must have."""
    a, b = THRESHOLD
    return -(-size * a // b)


class Templates:
    """Templates with their words in global order, rare ones first, and an index of their prefixes.

    A block that has `needed` of a template's words has one of its first size - needed + 1 in any fixed order."""

    def __init__(self, templates, frequency: dict[bytes, int]):
        self.order = {w: k for k, w in enumerate(sorted(
            {w for _, t in templates for w in t.encode().split()}, key=lambda w: (frequency.get(w, 0), w)))}
        self.labels = [label for label, _ in templates]
        self.words = [sorted(set(t.encode().split()), key=self.order.__getitem__) for _, t in templates]
        self.sets = [frozenset(w) for w in self.words]
        self.lengths = [len(t.split()) for _, t in templates]
        self.prefixes: dict[bytes, list[tuple[int, int]]] = {}
        for k, words in enumerate(self.words):
            for at, w in enumerate(words[:len(words) - needed(len(words)) + 1]):
                self.prefixes.setdefault(w, []).append((k, at))

    def within(self, words: list[bytes]) -> Iterator[tuple[int, int]]:
        """(template, shared words) of all templates that a block contains."""
        if self.prefixes.keys().isdisjoint(words):
            return
        mine = sorted(self.order.keys() & set(words), key=self.order.__getitem__)
        seen = set()
        for i, w in enumerate(mine):
            for k, at in self.prefixes.get(w, ()):
                size, need = len(self.words[k]), needed(len(self.words[k]))
                if k in seen or len(mine) < need:  # length
                    continue
                # position: words before this one are behind the first shared word of both
                if 1 + min(size - at - 1, len(mine) - i - 1) < need:
                    continue
                seen.add(k)
                shared = len(self.sets[k].intersection(mine))
                if shared >= need:
                    yield k, shared


    def runs(self, words: list[bytes]) -> Iterator[tuple[int, int, int, int]]:
        """(template, first, end, most shared words) of all stretches of a text in which each run of as many words as the
        template has contains it.

        Such a run has a word of the template's prefix, so only runs around those words are counted."""
        if self.prefixes.keys().isdisjoint(words):
            return
        around: dict[int, list[list[int]]] = {}
        for i, w in enumerate(words):
            for k, _ in self.prefixes.get(w, ()):
                a, b = max(0, i - self.lengths[k] + 1), min(len(words), i + self.lengths[k])
                parts = around.setdefault(k, [])
                if parts and a <= parts[-1][1]:
                    parts[-1][1] = b
                else:
                    parts.append([a, b])
        for k, parts in sorted(around.items()):
            for a, b in parts:
                yield from self._slide(k, words, a, b)

    def _slide(self, k: int, words: list[bytes], a: int, b: int) -> Iterator[tuple[int, int, int, int]]:
        mine, length, need = self.sets[k], self.lengths[k], needed(len(self.words[k]))
        inside: Counter[bytes] = Counter()
        shared, found = 0, None
        for end in range(a, b):
            w = words[end]
            if w in mine:
                inside[w] += 1
                shared += inside[w] == 1
            if end - length >= a and (w := words[end - length]) in mine:
                inside[w] -= 1
                shared -= inside[w] == 0
            if shared >= need:
                found = (found[0], end + 1, max(shared, found[2])) if found else (max(a, end - length + 1), end + 1, shared)
            elif found:
                yield k, *found
                found = None
        if found:
            yield k, *found


def phrase_places(words: list[bytes]) -> list[tuple[str, int, int, int]]:
    """(label, first, last, places) of each phrase whose words stand consecutively, by word number."""
    line = b" " + b" ".join(words) + b" "
    out = []
    for phrase, label in PHRASES.items():
        wanted, places, number, done = b" " + phrase.encode() + b" ", [], 0, 0
        at = line.find(wanted)
        while at >= 0:
            number += line.count(b" ", done, at)
            done = at
            places.append(number)
            at = line.find(wanted, at + 1)
        if places:
            out.append((label, places[0], places[-1], len(places)))
    return out


def word_frequency(docs: DataFrame, templates=TEMPLATES) -> dict[bytes, int]:
    """Blocks of all documents that have each template word; one number for each such word comes to the driver."""
    vocabulary = frozenset(w for _, t in templates for w in t.encode().split())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch["text"]:
                for words in blocks(text.as_py()):
                    total.update(vocabulary.intersection(words))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())], ["word", "n"])

    counts = docs.select("text").mapInArrow(count, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return {bytes(r["word"]): r["n"] for r in counts.collect()}


def license_notices(docs: DataFrame, templates=TEMPLATES, out: str = "licenses") -> DataFrame:
    """All rows and columns of `docs` and `out`: n_words, the phrases found (label, first and last word number, places)
    and the notices found (label, first word and end, shared words of the template, template size), in lines or in runs of
    words across them; a notice on one line is listed as a line and as a run.

    Templates are a fixed list, so every task holds them; documents are not shuffled. Null and empty texts have no words
    and nothing found; whole texts are read, in time linear in their words; repeated rows are scanned each. A column that
    is already named `out` is replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(Templates(templates, word_frequency(docs, templates)))

    @F.pandas_udf(FOUND)
    def scan(texts: pd.Series) -> pd.DataFrame:
        known, rows = shared.value, []
        for text in texts:
            lines = blocks(text)
            words = [w for line in lines for w in line]
            notices, first = [], 0
            for line in lines:
                notices += [(k, first, first + len(line), same) for k, same in sorted(known.within(line))]
                first += len(line)
            notices += known.runs(words)
            rows.append((len(words), [
                dict(zip(("label", "first", "last", "places"), p)) for p in phrase_places(words)
            ], [
                {"label": known.labels[k], "first": a, "end": b, "shared": same, "size": len(known.words[k])}
                for k, a, b, same in notices
            ]))
        return pd.DataFrame(rows, columns=["n_words", "phrases", "notices"])

    return docs.withColumn(out, scan(F.col("text")))


def _sql() -> str:
    """Brute force: every line, and every run that begins with a word of a template, against every template."""
    templates = ", ".join(
        f"({k}, '{label}', list_distinct(string_split('{text}', ' ')), {len(text.split())})" for k, (label, text) in enumerate(TEMPLATES))
    phrases = ", ".join(f"('{p}', '{label}', {len(p.split())})" for p, label in PHRASES.items())
    words = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    a, b = THRESHOLD
    return f"""
WITH d AS (SELECT doc_id, {lower} AS t, regexp_extract_all({lower}, '{words}') AS w FROM documents),
tpl AS (SELECT * FROM (VALUES {templates}) AS v(k, label, tw, length)),
phr AS (SELECT * FROM (VALUES {phrases}) AS v(p, label, n)),
lines AS (SELECT doc_id, list_distinct(regexp_extract_all(unnest(string_split(t, chr(10))), '{words}')) AS lw FROM d),
starts AS (
  SELECT doc_id, i, k FROM (SELECT doc_id, unnest(w) AS word, unnest(generate_series(1, len(w))) AS i FROM d)
  JOIN (SELECT k, unnest(tw) AS word FROM tpl) USING (word)),
runs AS (
  SELECT doc_id, label, tw, list_distinct(w[i:i + length - 1]) AS rw FROM starts JOIN tpl USING (k) JOIN d USING (doc_id)),
notices AS (
  SELECT doc_id, label, len(list_intersect(lw, tw)) AS shared, len(tw) AS size
  FROM lines, tpl WHERE {b} * len(list_intersect(lw, tw)) >= {a} * len(tw)
  UNION ALL
  SELECT doc_id, label, len(list_intersect(rw, tw)), len(tw)
  FROM runs WHERE {b} * len(list_intersect(rw, tw)) >= {a} * len(tw)),
places AS (
  SELECT doc_id, label, i - 1 AS place
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w))) AS i FROM d), phr
  WHERE array_to_string(w[i:i + n - 1], ' ') = p),
base AS (
  SELECT doc_id, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
  FROM places GROUP BY doc_id),
every AS (
  SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM (SELECT doc_id, label FROM places UNION ALL SELECT doc_id, label FROM notices) GROUP BY doc_id),
best AS (SELECT doc_id, max(shared / CAST(size AS DOUBLE)) AS score FROM notices GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(score, 0.0::DOUBLE) END AS score
FROM d LEFT JOIN base USING (doc_id) LEFT JOIN every USING (doc_id) LEFT JOIN best USING (doc_id)
"""


@query("op7_licenses", _sql())
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = license_notices(docs).select("doc_id", "licenses.*")
    base = F.transform("phrases", lambda p: p["label"])
    labels = F.concat(base, F.transform("notices", lambda n: n["label"]))
    listed = [F.array_join(F.array_sort(F.array_distinct(c)), ",") for c in (base, labels)]
    n_base = F.aggregate("phrases", F.lit(0).cast("bigint"), lambda n, p: n + p["places"])
    best = F.coalesce(F.array_max(F.transform("notices", lambda n: n["shared"] / n["size"])), F.lit(0.0))
    return found.select(
        "doc_id", "n_words", n_base.alias("n_base"), F.array_min("phrases.first").alias("first_word"),
        F.array_max("phrases.last").alias("last_word"), listed[0].alias("base_labels"), listed[1].alias("labels"),
        F.when(F.size("phrases") > 0, F.lit(1.0)).otherwise(best).alias("score"))
