"""Merkle trees over the paragraphs and sections of documents. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from reelspark.llm.common import query, table

DIGEST = 16
SHOWN = 8


def _digest(c: Column) -> Column:
    return F.substring(F.sha2(c.cast("binary"), 256), 1, DIGEST)


def _named(c: Column, use: Callable[[Column], Column]) -> Column:
    """use(c), with c worked out once however often it is used."""
    return F.transform(F.array(c), use)[0]


def fingerprint(text: Column) -> Column:
    """Merkle tree of a text, written as `root|section:paragraph[leaf leaf …] paragraph[…];section:…`.

    Paragraphs are the lines. A paragraph's leaves are runs of words that end behind punctuation or an s, so an edit
    changes only leaves that it touches, wherever text moves. A section ends with a paragraph whose digest starts with
    0 to 3, so an edit changes its own section and leaves the borders of others. Each inner digest is of the digests
    below it; leaves are shown shortened. Equal texts have equal fingerprints; different texts have different roots.
    Null counts as the empty text. Every step is linear in the text."""
    def paragraph(p: Column) -> Column:
        leaves = F.transform(F.split(p, "(?<=[.,;:!?s]) "), _digest)
        return _named(leaves, lambda x: F.concat(
            _digest(F.array_join(x, " ")), F.lit("["),
            F.array_join(F.transform(x, lambda leaf: F.substring(leaf, 1, SHOWN)), " "), F.lit("]")))

    paragraphs = F.array_join(F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), paragraph), "\n")
    # a section's last paragraph is followed by a blank line
    marked = F.regexp_replace(paragraphs, "(?m)^([0-3][^\\n]*)\\n", "$1\n\n")

    def section(s: Column) -> Column:
        return F.concat(_digest(F.regexp_replace(s, "\\[[^\\]]*\\]", "")), F.lit(":"), F.translate(s, "\n", " "))

    return _named(F.transform(F.split(marked, "\n\n"), section), lambda sections: F.concat(
        _digest(F.array_join(F.transform(sections, lambda s: F.substring(s, 1, DIGEST)), " ")), F.lit("|"),
        F.array_join(sections, ";")))


def root(tree: Column) -> Column:
    return F.substring(tree, 1, DIGEST)


def _leaves(tree: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(tree, F.lit(f"[\\[ ]([0-9a-f]{{{SHOWN}}})(?=[\\] ])"), F.lit(1)))


def likeness(a: Column, b: Column) -> Column:
    """Likeness of two trees, 0 to 1: 1 for equal roots, else the shared part of their distinct leaves."""
    sizes = _named(_leaves(a), lambda x: _named(_leaves(b), lambda y: F.struct(
        F.size(F.array_intersect(x, y)).alias("both"), (F.size(x) + F.size(y)).alias("sum"))))
    part = _named(sizes, lambda s: s["both"] / (s["sum"] - s["both"]))
    return F.when(root(a) == root(b), F.lit(1.0)).otherwise(part)


def edited_paragraphs(a: Column, b: Column) -> Column:
    """Paragraphs of `b`, counted from 0, that `a` lacks. Only sections whose digest `a` lacks are looked into."""
    def sections(t: Column) -> Column:
        return F.split(F.substring_index(t, "|", -1), ";")

    def paragraphs(s: Column) -> Column:
        return F.regexp_extract_all(s, F.lit(f"([0-9a-f]{{{DIGEST}}})\\["), F.lit(1))

    known = F.transform(sections(a), lambda s: F.substring(s, 1, DIGEST))
    old = F.flatten(F.transform(sections(a), paragraphs))
    flat = F.flatten(F.transform(sections(b), lambda s: F.transform(paragraphs(s), lambda p: F.struct(
        F.array_contains(known, F.substring(s, 1, DIGEST)).alias("same"), p.alias("p")))))
    at = F.transform(flat, lambda x, i: F.when(~x["same"] & ~F.array_contains(old, x["p"]), i))
    return F.when(root(a) == root(b), F.array().cast("array<int>")).otherwise(F.filter(at, lambda i: i.isNotNull()))


#: Lower bits of an id that a group of rows, and a group of groups, leave out: a group has at most 2^10 ids, a group of
#: groups 2^16, and what is left at the end 2^22 in all.
GROUP, UPPER = 10, (16, 16)


def following(keys: DataFrame, bits: tuple[int, ...] = UPPER) -> DataFrame:
    """(k, next) for distinct numbers k: the next smaller one, and the largest after the smallest.

    Numbers are grouped by their upper bits, so that no group can outgrow a task, whatever the numbers. A group's last
    member takes the first of the next group, which is found in the same way."""
    if not bits:
        return keys.select("k", F.coalesce(
            F.lead("k").over(W.partitionBy(F.lit(0)).orderBy(F.desc("k"))), F.max("k").over(W.partitionBy(F.lit(0)))
        ).alias("next"))
    upper = keys.withColumn("up", F.shiftright("k", bits[0]))
    near = upper.withColumn("near", F.lead("k").over(W.partitionBy("up").orderBy(F.desc("k"))))
    tops = upper.groupBy("up").agg(F.max("k").alias("top"))
    over = following(tops.select(F.col("up").alias("k")), bits[1:])
    first = over.join(tops.withColumnRenamed("up", "next"), "next").select(F.col("k").alias("up"), "top")
    return near.join(first, "up").select("k", F.coalesce("near", "top").alias("next"))


def with_next(rows: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value, next_value) of all rows: the value of the row with the next smaller key, of the largest after the
    smallest. Equal keys follow each other by `value`; a null key counts as the smallest number."""
    rows = rows.select(key, value, F.coalesce(F.col(key), F.lit(-2**63)).alias("_k"))
    rows = rows.withColumn("_g", F.shiftright("_k", GROUP))
    # the key is in the order so that all uses of the groups need the same columns and share one shuffle
    by = W.partitionBy("_g").orderBy(F.desc("_k"), key, value)
    near = rows.withColumns({
        "_near": F.lead(value).over(by), "_first": F.lag(F.lit(1)).over(by).isNull(),
        "_last": F.lead(F.lit(1)).over(by).isNull(),
    })
    groups = following(rows.select(F.col("_g").alias("k")).distinct())
    heads = near.filter("_first").select(F.col("_g").alias("next"), F.col(value).alias("_head"))
    linked = groups.join(heads, "next").select(F.col("k").alias("_g"), "_head")
    found = near.join(linked, "_g", "left")  # rows are dealt and sorted by _g already
    return found.select(key, value, F.when(F.col("_last"), F.col("_head")).otherwise(F.col("_near")).alias(f"next_{value}"))


def compared(docs: DataFrame) -> DataFrame:
    """doc_id, text, edited text, and the fingerprints of both and of the next document by descending doc_id.

    The edited text has its last floor(n/3) code points replaced by the next document's first as many, or all of them.
    Null texts are empty. Repeated rows are compared each; a document alone is its own next one; an empty table gives no
    rows. Other columns of `docs` are left out."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    n = F.char_length("text")
    third = F.floor(n / 3).cast("int")
    rows = with_next(texts, "doc_id", "text").withColumn(
        "edited", F.concat(F.substring("text", F.lit(1), n - third), F.substring("next_text", F.lit(1), third)))
    return rows.select(
        "doc_id", "text", "edited", fingerprint(F.col("text")).alias("fingerprint"),
        fingerprint(F.col("edited")).alias("edited_fingerprint"), fingerprint(F.col("next_text")).alias("next_fingerprint"))


@query("op6_fingerprints")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = compared(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", F.char_length("text").cast("bigint").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))
