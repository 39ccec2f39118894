import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SF = "/root/testdata/sf0.001"


@pytest.fixture
def documents(spark):
    """Documents from texts or (doc_id, text); a None text stays null."""
    def make(texts):
        rows = [t if isinstance(t, tuple) else (k, t) for k, t in enumerate(texts)]
        return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)

    return make


@pytest.fixture
def odd(spark):
    """Null ids and texts, empty and very long texts, repeated rows, and columns whose names the operators use inside."""
    long = " ".join(f"w{k}" for k in range(60_000))
    rows = [
        (1, None), (2, ""), (3, long), (4, "one two three"), (4, "one two three"), (None, "no id here"), (6, " \n\t "),
        (7, "one two three"), (8, "x" * 300_000),
    ]
    clash = "token int, tokens int, id int, a int, b int, n int, k int, component int, score double, size string, cell int, shard int, slot int, words int, items int, spans int, doc int, key int, row int, salt int"
    count = len(clash.split(","))
    inner = ["_bucket", "_score", "_contamination", "_n", "_k", "_rank", "_at"]
    names = f"{DOCS}, {clash}, {', '.join(f'{c} int' for c in inner)}"
    return spark.createDataFrame([(i, t, None, None, None, *[None] * count, *[5] * len(inner)) for i, t in rows], names)


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], DOCS)
