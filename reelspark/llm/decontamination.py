"""Benchmark decontamination: Wu-Manber search for benchmark word windows in documents."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from reelspark.llm.common import alnum_words, free_name, query, table, written

WINDOW = 10
#: Windows that one broadcast holds, about 100 MB in a worker; a larger benchmark is searched block by block, one at a time.
BLOCK = 100_000
#: Copies of the hits of a text that documents with very common texts spread over.
SPREAD = 16
HITS = "struct<n_words:bigint,spans:array<struct<first:bigint,end:bigint>>,items:array<bigint>>"


class WuManber:
    """Search for word sequences of one length.

    A block is the last two words (or the only one) of a position. `shift` says how far the search may move on from a
    block; blocks that end a pattern have shift 0 and select the patterns to compare with."""

    def __init__(self, patterns: dict[tuple[bytes, ...], list[int]]):
        self.length = len(next(iter(patterns)))
        self.block = min(2, self.length)
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.ending: dict[tuple[bytes, ...], list[tuple[list[bytes], list[int]]]] = {}
        for words, items in patterns.items():
            for end in range(self.block, self.length + 1):
                block = words[end - self.block:end]
                self.shift[block] = min(self.shift.get(block, self.length), self.length - end)
            self.ending.setdefault(words[-self.block:], []).append((list(words), items))

    def find(self, words: list[bytes]) -> Iterator[tuple[int, list[int]]]:
        """Starts of occurrences, with the items that have the window."""
        size, block, shift = self.length, self.block, self.shift.get
        furthest, end, n = size - block + 1, size, len(words)
        while end <= n:
            seen = tuple(words[end - block:end])
            step = shift(seen, furthest)
            if step:
                end += step
                continue
            here = words[end - size:end]
            for pattern, items in self.ending[seen]:
                if pattern == here:
                    yield end - size, items
            end += 1


def windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """Distinct (item_id, window): every run of `size` words of an item; an item of fewer words, but not none, whole.
    Words are space-joined. Null texts give no window; windows of items without id have a null id."""

    @F.pandas_udf("array<string>")
    def cut(texts: pd.Series) -> pd.Series:
        def one(text: str | None) -> list[str]:
            words = [w.decode("utf-8", "surrogatepass") for w in alnum_words(text)]
            return sorted({" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))}) if words else []

        return texts.map(one, na_action=None)

    return benchmark.select(F.col("item_id").cast("bigint"), F.explode(cut("text")).alias("window")).distinct()


def _search(matchers) -> Callable[[Column], Column]:
    """UDF of the hits of one block in a text."""

    @F.pandas_udf(HITS)
    def scan(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_hits(matchers.value, t) for t in texts], columns=["n_words", "spans", "items"])

    return scan


def _merged(marks: list[tuple[int, int]]) -> list[dict[str, int]]:
    merged: list[list[int]] = []
    for first, end in sorted(marks):
        if merged and first <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([first, end])
    return [{"first": a, "end": b} for a, b in merged]


def _hits(matchers: list[WuManber], text: str | None) -> tuple[int, list, list[int]]:
    words = alnum_words(text)
    marks, ids = [], set()
    for m in matchers:
        for at, of in m.find(words):
            marks.append((at, at + m.length))
            ids.update(of)
    return len(words), _merged(marks), sorted(ids)


def _joined(spans: str) -> Column:
    """Spans of several blocks, merged."""

    @F.pandas_udf("array<struct<first:bigint,end:bigint>>")
    def join(parts: pd.Series) -> pd.Series:
        return parts.map(lambda found: _merged([(s["first"], s["end"]) for s in found]))

    return join(F.col(spans))


def contamination(
    docs: DataFrame, benchmark: DataFrame, out: str = "contamination", size: int = WINDOW, block: int = BLOCK
) -> DataFrame:
    """All rows and columns of `docs` and a struct column `out`: n_words, merged word spans [first, end) inside
    occurrences of benchmark windows, and the items that have them.

    A benchmark of up to `block` windows is broadcast and searched within one pass over the documents, without a shuffle.
    A larger one is dealt into blocks of about that many, built, broadcast and searched one after another; the hits of
    each, one row for each text that has any, are written, and are joined to the documents at the end. So driver and
    workers hold one block at a time, whatever the benchmark.

    Null and empty texts have no words and no hits. An empty benchmark hits nothing; items without id hit words but are
    not listed. Repeated rows are searched each. A column that is already named `out` is replaced."""
    spark = docs.sparkSession
    marked = written(windows(benchmark, size).groupBy("window").agg(F.sort_array(F.collect_set("item_id")).alias("items")))
    blocks = max(1, -(-marked.count() // block))

    def matchers(k: int):
        by_length: dict[int, dict[tuple[bytes, ...], list[int]]] = {}
        for r in marked.filter(F.pmod(F.xxhash64("window"), F.lit(blocks)) == k).toLocalIterator():
            words = tuple(w.encode("utf-8", "surrogatepass") for w in r.window.split(" "))
            by_length.setdefault(len(words), {})[words] = r["items"]
        return spark.sparkContext.broadcast([WuManber(p) for _, p in sorted(by_length.items())])

    if blocks == 1:
        return docs.withColumn(out, _search(matchers(0))(F.col("text")))
    parts = []
    for k in range(blocks):
        shared = matchers(k)
        found = docs.select(F.sha2("text", 256).alias("key"), _search(shared)(F.col("text")).alias("hits"))
        parts.append(written(found.filter("size(hits.spans) > 0").select("key", "hits.spans", "hits.items").dropDuplicates(["key"])))
        shared.destroy()
    hits = reduce(DataFrame.union, parts).groupBy("key").agg(
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))  # a row for each block
    hits = hits.select(
        "key", _joined("spans").alias("spans"), "items", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))).alias("salt"))
    # every copy of the hits is the same, so it does not matter which one a document meets
    whole = docs.select(
        F.struct("*").alias("doc"), F.sha2("text", 256).alias("key"), (F.spark_partition_id() % SPREAD).alias("salt"),
        _search(spark.sparkContext.broadcast([]))(F.col("text"))["n_words"].alias("n_words"))
    none = F.expr(f"cast(named_struct('n_words', 0L, 'spans', array(), 'items', array()) as {HITS})")
    result = F.struct(
        "n_words", F.coalesce("spans", none["spans"]).alias("spans"), F.coalesce("items", none["items"]).alias("items"))
    rows = whole.join(hits, ["key", "salt"], "left").select("doc", result.alias("result"))
    return rows.select(*[F.col("doc")[c].alias(c) for c in docs.columns if c.lower() != out.lower()], F.col("result").alias(out))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """Rows of `docs` without any benchmark window, with all their columns, whatever their names.

    Null and empty texts stay, as does every row where the benchmark is empty; repeated rows stay or go together; whole
    texts are searched. An empty table gives no rows."""
    mark = free_name(docs, "_contamination")
    return contamination(docs, benchmark, mark, size).filter(F.size(F.col(mark)["spans"]) == 0).drop(mark)


OP8_SQL = """
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
bw AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS g
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM bw WHERE len(w) > 0)),
dg AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i
        FROM dw, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
hit AS (SELECT DISTINCT doc_id, i, dg.n, item_id FROM dg JOIN win ON dg.g = win.g AND dg.n = win.n),
words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM hit) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(s) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(len(w), 0) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query("op8_decontamination", OP8_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    c = contamination(docs, table(spark, sf_dir, "benchmark")).select("doc_id", "contamination.*")
    ids = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["first"])
    return c.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
    )
