"""Best-two-fit packing of tokenised documents into sequences of fixed length."""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from reelspark.llm.common import query, table, written

CAPACITY = 1024
END = 2
TOKENIZER = "byte_bpe_50k.json"
#: Pieces of one length that are ranked together, about.
RANKED = 1000

#: Fixed value: the published splitting pattern of this kind of byte-level vocabulary.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


@lru_cache(maxsize=2)
def encoder(path: str):
    """Encoder with the byte-level vocabulary in `path`. Its ids are merge ranks, so a rank-based encoder gives the ids
    that `tokenizers` gives (tested), several times as fast. Added tokens have one id wherever they stand in a text, as there."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    vocab, added = spec["model"]["vocab"], {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    # printable bytes stand for themselves, the others, in order, for the characters from U+0100
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte_of = {chr(b): b for b in shown}
    byte_of |= {chr(0x100 + k): b for k, b in enumerate(b for b in range(256) if b not in set(shown))}
    ranks = {bytes(byte_of[c] for c in token): i for token, i in vocab.items() if token not in added}
    return tiktoken.Encoding("byte_bpe", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=added)


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """Pieces of all documents: doc_id, piece, start, length, ids (little-endian unsigned 32-bit ids).

    A document's ids are its text's and then `end`; null and empty texts have `end` alone. Only documents longer than
    `capacity` are cut; the first piece takes what the others, of full length, leave. Repeated rows are cut each."""
    path = path or tokenizer_path()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 200):  # few texts at a time, to keep batches small
                rows = []
                some = batch.slice(at, 200)
                for doc_id, text in zip(some["doc_id"].to_pylist(), some["text"].to_pylist()):
                    ids = np.array([*enc.encode(text or "", allowed_special="all"), end], "<u4")
                    first = len(ids) % capacity or capacity
                    bounds = [0, *range(first, len(ids) + 1, capacity)]
                    rows += [
                        (doc_id, k, a, b - a, ids[a:b].tobytes()) for k, (a, b) in enumerate(zip(bounds, bounds[1:]))]
                columns = [pa.array(c, t.type) for c, t in zip(zip(*rows), schema)]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    schema = pa.schema([
        ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())])
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        cut, "doc_id bigint, piece int, start bigint, length bigint, ids binary")


def best_two_fit(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """Fillings and their number of copies, for `counts[length]` pieces.

    A bin starts with the longest piece and takes the longest that fits until none does. Then its shortest piece is
    replaced by two unpacked ones that fill the gap, widened by that piece, better than it did, while there are such.
    Equal bins are filled at once: a filling is repeated until one of its lengths runs short. Each filling so exhausts a
    length but for a few pieces, and the number of fillings is bounded by the capacity, not by the pieces."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    out = []
    while (lengths := np.flatnonzero(left)).size:
        free, filling, gap = left.copy(), [], capacity

        def put(length: int) -> None:
            nonlocal gap
            filling.append(length)
            free[length] -= 1
            gap -= length

        put(int(lengths[-1]))
        while (fits := np.flatnonzero(free[1:gap + 1])).size:
            put(int(fits[-1]) + 1)
        while gap and len(filling) > 1:
            least = min(filling)
            pair = _closest_pair(free, gap + least)
            if pair is None or sum(pair) <= least:
                break
            filling.remove(least)
            free[least] += 1
            gap += least
            put(pair[0])
            put(pair[1])
        uses = Counter(filling)
        copies = int(min(left[x] // n for x, n in uses.items()))
        for x, n in uses.items():
            left[x] -= n * copies
        out.append((sorted(filling, reverse=True), copies))
    return out


def _closest_pair(free: np.ndarray, room: int) -> tuple[int, int] | None:
    """Two free lengths with the largest sum within `room`."""
    there = free[:room] > 0
    there[0] = False
    longest = np.maximum.accumulate(np.where(there, np.arange(room), 0))  # longest free length up to each
    a = np.flatnonzero(there)
    if not a.size:
        return None
    b = longest[room - a]
    once = (b == a) & (free[a] < 2)  # a single piece can't be taken twice
    b = np.where(once, longest[np.maximum(a - 1, 0)], b)
    sums = np.where(b > 0, a + b, 0)
    k = int(sums.argmax())
    return (int(a[k]), int(b[k])) if sums[k] else None


def packed(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """All rows and columns of `pieces`, with sequence_id and offset.

    Which lengths share a sequence is planned from the number of pieces of each length, at most `capacity` numbers
    whatever the input. The k-th piece of a length then takes the k-th place planned for it; k comes from counts of
    hashed buckets of a length and the order within a bucket, so a common length spreads over many tasks. An empty
    input gives no rows; repeated rows take a place each. `pieces` is read twice and should be a written table. User columns
    named sequence_id or offset are replaced; all others keep their values."""
    spark = pieces.sparkSession
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    buckets = F.lit([counts.get(length, 0) // RANKED + 1 for length in range(capacity + 1)])[F.col("length").cast("int")]
    keys = [c for c in ("doc_id", "piece", "start", "ids_crc32") if c in pieces.columns]
    kept = [F.col(c) for c in pieces.columns if c.lower() not in ("sequence_id", "offset")]
    dealt = pieces.select(
        "length", *keys, F.struct(*kept).alias("row"), F.pmod(F.xxhash64(*keys), buckets).alias("_bucket"))
    sizes = dealt.groupBy("length", "_bucket").agg(F.count("*").alias("_n"))
    earlier = W.partitionBy("length").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    first = sizes.select("length", "_bucket", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_first"))
    within = F.row_number().over(W.partitionBy("length", "_bucket").orderBy(*keys))
    ranked = dealt.withColumn("_k", within - 1).join(first, ["length", "_bucket"])

    taken, places, base = Counter(), [], 0
    for filling, copies in best_two_fit(counts, capacity):
        offset = 0
        for length in filling:
            places.append((length, taken[length], base, offset))
            taken[length] += copies
            offset += length
        base += copies
    plan = np.array(sorted(places), np.int64).reshape(-1, 4)
    shared = spark.sparkContext.broadcast((plan[:, 0] << 44 | plan[:, 1], plan[:, 1:]))

    @F.pandas_udf("struct<sequence_id:bigint,offset:bigint>")
    def place(length: pd.Series, k: pd.Series) -> pd.DataFrame:
        keys, to = shared.value
        at = np.searchsorted(keys, length.to_numpy() << 44 | k.to_numpy(), "right") - 1
        return pd.DataFrame({"sequence_id": to[at, 1] + k.to_numpy() - to[at, 0], "offset": to[at, 2]})

    put = ranked.withColumn("_at", place("length", F.col("_first") + F.col("_k")))
    return put.select("row.*", "_at.sequence_id", "_at.offset")


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """Pieces with their place: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Only doc_id and text are read. Null and empty texts are one piece, the end token; whole texts are packed, repeated rows
    each; null ids stay null. An empty table gives no pieces."""
    cut = pieces(docs, path, capacity, end).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packed(written(cut), capacity)


def sequences(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """The sequences themselves: sequence_id, ids (binary), and the documents in them in order.

    Rows are taken as by `pack_documents`."""
    put = packed(written(pieces(docs, path, capacity, end)), capacity)
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids", "doc_id", "piece")))  # at most `capacity` pieces
    return put.groupBy("sequence_id").agg(parts.alias("p")).select(
        "sequence_id", F.expr("aggregate(p, cast('' as binary), (a, x) -> concat(a, x.ids))").alias("ids"),
        F.col("p.doc_id").alias("doc_ids"))


@query("op3_packing")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
