"""Trees, edits, and the neighbour by descending id."""

import hashlib

import pytest
from pyspark.sql import functions as F

from reelspark.llm import fingerprints as f


def trees(spark, *texts):
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    return [r[0] for r in df.select(f.fingerprint(F.col("text"))).collect()]


def test_equal_and_different_texts(spark):
    texts = ["a b.\nc", "a b.\nc", "a b. c", "", None, "\n", "\n\n", "a", "a.", "a. ", " a", "a  b", "a b"]
    got = trees(spark, *texts)
    assert got[0] == got[1] and got[3] == got[4]
    assert len({g.split("|")[0] for g in got}) == len(texts) - 2


def test_tree_is_merkle(spark):
    def digest(s):
        return hashlib.sha256(s.encode()).hexdigest()[:16]

    tree, = trees(spark, "one two.\nthree")
    paragraphs = [digest(digest("one two.")), digest(digest("three"))]
    assert all(p in tree for p in paragraphs)
    if ";" not in tree:
        section = digest(" ".join(paragraphs).replace(" ", "\n"))
        assert tree.startswith(digest(section) + "|" + section)


def test_edits_are_located(spark):
    lines = [f"paragraph {k}, with words and {k * 7}." for k in range(200)]
    changed = [*lines]
    changed[120] = "something else"
    df = spark.createDataFrame([("\n".join(lines), "\n".join(changed))], "a string, b string")
    pair = df.select(f.fingerprint(F.col("a")).alias("a"), f.fingerprint(F.col("b")).alias("b"))
    row = pair.select(f.edited_paragraphs(F.col("a"), F.col("b")).alias("e"), f.likeness(F.col("a"), F.col("b")).alias("l"),
                      f.likeness(F.col("a"), F.col("a")).alias("same")).first()
    assert row.e == [120] and 0.95 < row.l < 1 and row.same == 1.0
    a, b = (x.split("|")[1].split(";") for x in pair.first())
    assert len(a) > 20 and len(set(a) - set(b)) <= 3


@pytest.mark.parametrize("ids", [[5], [1, 2, 3], [-7, 0, 1 << 40, (1 << 40) + 1, 1023, 1024, 1025, 1 << 62, -(1 << 62)],
                                 list(range(0, 5000, 3))])
def test_next_row(spark, ids):
    df = spark.createDataFrame([(i, f"t{i}") for i in ids], "doc_id bigint, text string")
    got = {r.doc_id: r.next_text for r in f.with_next(df, "doc_id", "text").collect()}
    down = sorted(ids, reverse=True)
    assert got == {i: f"t{down[(k + 1) % len(down)]}" for k, i in enumerate(down)}


def test_odd_rows(odd, nothing):
    rows = f.compared(odd).collect()
    assert len(rows) == 9
    for r in rows:
        n = len(r.text)
        assert r.edited.startswith(r.text[:n - n // 3]) and len(r.edited) <= n
    assert f.compared(nothing).collect() == []


def test_no_python_in_the_plan(odd):
    plan = f.compared(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
