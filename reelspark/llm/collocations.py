"""Phrase collocations: texts become chunks of word numbers once; n-grams are counted level by level, by the names of their
words; Rabin-Karp fingerprints sort out those whose parts are rare."""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from reelspark.llm.common import collect_garbage, query, table, written

#: Tokens whose n-grams are counted together in a task, and bytes of a text that are split at once.
CHUNK, SEGMENT = 1 << 20, 1 << 22
#: Rows that a task hands to Spark at once.
ROWS = 1 << 18
#: Distinct words that a task numbers before it starts anew.
WORDS = 400_000
#: Bits of a filter of frequent fingerprints: 16 for each, between these bounds. A fuller filter lets more through that the
#: counts then drop, so the bound costs time, never rows.
LEAST_BITS, MOST_BITS = 1 << 16, 1 << 27
BASE = 0x9E3779B97F4A7C15
UNKNOWN = "und"

#: Lower case for A-Z; what ends a piece becomes the byte 0xFF, which no UTF-8 text holds; a tab becomes a space.
_END = 0xFF
_TABLE = bytes(_END if c in b".,;:!?\n\x0b\x0c\r" else 0x20 if c == 9 else c for c in bytes(range(256)).lower())


class WordIds(dict):
    """Numbers of words, 0 for the end of a piece, with a 64-bit hash of each."""

    def __init__(self, seed: int = 0) -> None:
        super().__init__({bytes([_END]): 0})
        self.hashes, self.seed = [0], seed

    def __missing__(self, word: bytes) -> int:
        self[word] = k = len(self)
        self.hashes.append(xxhash.xxh64_intdigest(word, self.seed))
        return k


def token_ids(text: str, known: WordIds) -> np.ndarray:
    """Word numbers of a text, 0 between pieces and at its end."""
    raw = text.encode("utf-8", "surrogatepass").translate(_TABLE)
    parts, at = [], 0
    while at < len(raw):
        end = at + SEGMENT
        if end < len(raw):  # cut where a word ends
            cut = max(raw.rfind(b" ", at, end), raw.rfind(b"\xff", at, end))
            while cut < at and end < len(raw):
                end += SEGMENT
                cut = max(raw.rfind(b" ", at, end), raw.rfind(b"\xff", at, end))
            end = cut + 1 if cut >= at else len(raw)
        # the other white space that split() knows has become the end of a piece
        words = raw[at:end].replace(b"\xff", b" \xff ").split()
        parts.append(np.fromiter(map(known.__getitem__, words), np.int64, len(words)))
        at = end
    return np.concatenate([*parts, np.zeros(1, np.int64)])


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of the base and of its inverse modulo 2^64, up to a chunk's length."""

    def __init__(self, size: int):
        self.up, self.down = (
            np.cumprod(np.array([1] + [b] * size, np.uint64), dtype=np.uint64) for b in (BASE, pow(BASE, -1, 1 << 64)))

    def grams(self, hashes: np.ndarray, n: int, lang: int) -> np.ndarray:
        """Fingerprints of the n-grams at all places: differences of prefix polynomials, scaled to degree 0 at their end."""
        prefix = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(hashes * self.down[:len(hashes)], out=prefix[1:])
        k = max(0, len(hashes) - n + 1)
        return self.named((prefix[n:n + k] - prefix[:k]) * self.up[n - 1:n - 1 + k], n, lang)

    @staticmethod
    def named(prints: np.ndarray, n: int, lang: int) -> np.ndarray:
        """Fingerprints told apart by length and language."""
        return mixed(prints + np.uint64((n * 0xD6E8FEB86659FD93 + lang) % (1 << 64)))


def lang_hash(lang: str) -> int:
    return xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"), 1)


@dataclass
class Frequent:
    """A Bloom filter of fingerprints: no frequent one is missed."""

    bits: np.ndarray

    def has(self, prints: np.ndarray) -> np.ndarray:
        mask = np.uint64(len(self.bits) * 64 - 1)
        left = np.arange(len(prints))
        for shift in SHIFTS:
            at = (prints[left] >> np.uint64(shift)) & mask
            left = left[(self.bits[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)]
        out = np.zeros(len(prints), bool)
        out[left] = True
        return out


SHIFTS = (0, 19, 37)


def frequent_filter(prints: DataFrame) -> Broadcast:
    """A broadcast filter of the column `print`; at most MOST_BITS bits, whatever the input."""
    spark = prints.sparkSession
    size = LEAST_BITS
    count = prints.count()
    while size < min(MOST_BITS, 16 * count):
        size *= 2
    places = [F.shiftrightunsigned("print", s).bitwiseAND(F.lit(size - 1)) for s in SHIFTS]
    words = prints.select(F.explode(F.array(*places)).alias("at")).groupBy(
        F.shiftright("at", 6).cast("int").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits")).toArrow()
    bits = np.zeros(size // 64, np.uint64)
    bits[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return spark.sparkContext.broadcast(Frequent(bits))


@dataclass
class Chunk:
    """Tokens of one language, a chunk and a few more that only continue n-grams, and the document of each."""

    ids: np.ndarray
    docs: np.ndarray
    lang: str


def _chunks(batches: Iterator[pa.RecordBatch], longest: int, chunk: int, known: WordIds) -> Iterator[Chunk]:
    """Token runs by language, by falling document. The language that holds most is handed on when all hold three chunks
    together."""
    held: dict[str, list[tuple[np.ndarray, int]]] = {}
    sizes: dict[str, int] = {}

    def flush(lang: str) -> Iterator[Chunk]:
        texts = sorted(held.pop(lang), key=lambda text: -text[1])
        del sizes[lang]
        every = np.concatenate([t for t, _ in texts])
        of = np.repeat([d for _, d in texts], [len(t) for t, _ in texts])
        texts.clear()
        for at in range(0, len(every), chunk):
            end = at + chunk + longest - 1
            yield Chunk(every[at:end], of[at:end], lang)

    for batch in batches:
        for lang, doc, text in zip(batch["lang"].to_pylist(), batch["doc_id"].to_pylist(), batch["text"]):
            text = text.as_py()
            if text:
                tokens = token_ids(text, known).astype(np.int32)
                held.setdefault(lang, []).append((tokens, -1 if doc is None else doc))
                sizes[lang] = sizes.get(lang, 0) + len(tokens)
                if sum(sizes.values()) >= 3 * chunk:
                    yield from flush(max(sizes, key=sizes.get))
            if len(known) > WORDS:
                for some in list(held):
                    yield from flush(some)
                known.clear()
                known.__init__(known.seed)
    for some in list(held):
        yield from flush(some)


def packed(ids: np.ndarray) -> bytes:
    """Word numbers, compressed; first all low bytes, then all second ones, and so on."""
    return pa.compress(ids.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes(), codec="zstd", asbytes=True)


def unpacked(raw: pa.Buffer, size: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(raw, decompressed_size=4 * size, codec="zstd"), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<i4")[:, 0]


CHUNKS = pa.schema([
    ("lang", pa.string()), ("ids", pa.binary()), ("words", pa.list_(pa.string())), ("names", pa.list_(pa.int64())),
    ("counts", pa.list_(pa.int64())), ("seen", pa.list_(pa.int64())), ("docs", pa.list_(pa.int64())),
    ("lengths", pa.list_(pa.int64()))])


def word_chunks(texts: DataFrame, longest: int, chunk: int, seed: int) -> DataFrame:
    """Texts as chunks of word numbers, written. A row: the words of a chunk by falling count, the name of each (64 bits of its
    hash and language), how often it begins an n-gram there and the smallest document it does so in; the tokens as places
    in that list, from 1, and 0 for the end of a piece; the runs of tokens of one document."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordIds(seed)
        for part in _chunks(batches, longest, chunk, known):
            spelled, starts = list(known), part.ids[:chunk]
            counts, seen = np.bincount(starts, minlength=len(known)), np.zeros(len(known), np.int64)
            seen[starts] = part.docs[:chunk]  # of a word's documents the last one stays, and they fall
            used = np.bincount(part.ids, minlength=len(known)) > 0
            used[0] = False
            words = np.flatnonzero(used)
            words = words[np.argsort(-counts[words], kind="stable")]
            number = np.zeros(len(known), np.int32)
            number[words] = np.arange(1, len(words) + 1)
            names = Powers.named(np.array(known.hashes, np.uint64)[words], 1, lang_hash(part.lang))
            runs = np.flatnonzero(np.append(True, part.docs[1:] != part.docs[:-1]))
            yield pa.RecordBatch.from_pydict({
                "lang": [part.lang], "ids": [packed(number[part.ids])],
                "words": [[spelled[i].decode("utf-8", "surrogatepass") for i in words.tolist()]], "names": [names.view(np.int64)],
                "counts": [counts[words]], "seen": [seen[words]], "docs": [part.docs[runs]],
                "lengths": [np.diff(np.append(runs, len(part.docs)))]}, schema=CHUNKS)

    return written(texts.mapInArrow(
        split, "lang string, ids binary, words array<string>, names array<bigint>, counts array<bigint>, seen array<bigint>, "
        "docs array<bigint>, lengths array<bigint>"))


def _candidates(ids: np.ndarray, names: np.ndarray, n: int, shorter: Frequent, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """Places and fingerprints of n-grams within pieces whose first and last n - 1 words pass the filter."""
    k = len(ids) - n + 1
    if k < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    of = names[ids]
    if n == 2:
        good = shorter.has(names)
        good[0] = False
        fits = good[ids]
    else:
        word = ids > 0
        fits = np.logical_and.reduce([word[t:t + k + 1] for t in range(n - 1)])
        at = np.flatnonzero(fits)
        fits[at] = shorter.has(powers.grams(of, n - 1, 0)[at])
    at = np.flatnonzero(fits[:k] & fits[1:k + 1])
    return at, powers.grams(of, n, 0)[at]


def _gram_counts(chunks: DataFrame, n: int, shorter: Broadcast, longest: int, chunk: int) -> DataFrame:
    """The n-grams of words and of n - 1 words that pass the filter, by the names of their words, with their counts."""
    columns = [f"w{t}" for t in range(n)]

    def found(raw: pa.Scalar, names: pa.Scalar, docs: pa.Scalar, lengths: pa.Scalar, powers: Powers) -> pa.RecordBatch | None:
        docs = np.repeat(docs.values.to_numpy(), lengths.values.to_numpy())
        names = np.append(np.uint64(0), names.values.to_numpy().view(np.uint64))
        ids = unpacked(raw.as_buffer(), len(docs))
        at, prints = _candidates(ids, names, n, shorter.value, powers)
        inside = at < chunk  # later ones begin in the next chunk
        at, prints = at[inside], prints[inside]
        if not len(at):
            return None
        place, starts = _grouped(prints, at, ids, n)
        first = place[starts]
        return pa.RecordBatch.from_pydict({
            **{c: names[ids[first + t]].view(np.int64) for t, c in enumerate(columns)},
            "count": np.diff(np.append(starts, len(place))), "seen_doc": np.minimum.reduceat(docs[place], starts)})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers(chunk + longest)
        for batch in batches:
            for row in range(batch.num_rows):
                grams = found(*(batch[c][row] for c in ("ids", "names", "docs", "lengths")), powers)
                for k in range(0, grams.num_rows if grams else 0, ROWS):
                    yield grams.slice(k, ROWS)
                del grams

    counts = chunks.select("ids", "names", "docs", "lengths").mapInArrow(
        count, ", ".join(f"{c} bigint" for c in [*columns, "count", "seen_doc"]))
    return counts.groupBy(*columns).agg(F.sum("count").alias("count"), F.min("seen_doc").alias("seen_doc"))


def _prints(grams: DataFrame, n: int) -> DataFrame:
    """Fingerprints of n-grams that are given by the names of their words."""

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total = np.zeros(batch.num_rows, np.uint64)
            for column in batch.columns:
                total = total * np.uint64(BASE) + column.to_numpy().view(np.uint64)
            yield pa.RecordBatch.from_pydict({"print": Powers.named(total, n, 0).view(np.int64)})

    return grams.select(*(f"w{t}" for t in range(n))).mapInArrow(prints, "print bigint")


def _grouped(prints: np.ndarray, at: np.ndarray, ids: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of equal n-grams together, and where each group starts. Equal fingerprints are compared word by word, so that
    a collision makes two groups."""
    order = np.argsort(prints)
    s, place = prints[order], at[order]
    new = np.concatenate([[True], s[1:] != s[:-1]])
    first = np.repeat(place[new], np.diff(np.append(np.flatnonzero(new), len(s))))
    if any((ids[place + t] != ids[first + t]).any() for t in range(n)):
        order = np.lexsort([*(ids[at + t] for t in reversed(range(n))), prints])
        place = at[order]
        new = np.concatenate([[True], np.any([ids[place[1:] + t] != ids[place[:-1] + t] for t in range(n)], axis=0)])
    return place, np.flatnonzero(new)


def named_words(texts: DataFrame, longest: int, chunk: int) -> tuple[DataFrame, DataFrame]:
    """The chunks of all texts, and all words: name, lang, word, count, seen_doc. No two words have one name; where two do, all
    get others."""
    for seed in itertools.count():
        chunks = word_chunks(texts, longest, chunk, seed)
        each = chunks.select("lang", F.inline(F.arrays_zip("words", "names", "counts", "seen"))).filter("counts > 0")
        words = written(each.groupBy(F.col("names").alias("name"), "lang", F.col("words").alias("word")).agg(
            F.sum("counts").alias("count"), F.min("seen").alias("seen_doc")))
        if words.groupBy("name").count().filter("count > 1").isEmpty():
            return chunks, words


def phrase_counts(docs: DataFrame, least: int = 30, longest: int = 4, chunk: int = CHUNK) -> DataFrame:
    """Counts of all phrases of 1 to `longest` words that occur at least `least` times in a language: lang, n_words, phrase,
    count, and seen_doc, the smallest doc_id it occurs in; n_words 0 has the number of all words.

    A phrase lies within a piece. The texts are read once and written as chunks of word numbers. All words are counted first;
    each has a name of 64 bits that no other has, which is checked. No phrase is more frequent than its parts, so pairs of
    frequent words come next, then n-grams whose both parts of n - 1 words are frequent. They are counted by the names of
    all their words; fingerprints only sort out and group, so a collision changes no count. Null texts are empty, null
    languages UNKNOWN, repeated rows count each."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), "text")
    chunks, words = named_words(texts, longest, chunk)
    single = words.filter(F.col("count") >= least)
    shorter, levels = frequent_filter(single.select(F.col("name").alias("print"))), []
    for n in range(2, longest + 1):
        collect_garbage(docs.sparkSession)
        grams = written(_gram_counts(chunks, n, shorter, longest, chunk).filter(F.col("count") >= least))
        levels.append(grams.select(F.array(*(f"w{t}" for t in range(n))).alias("names"), "count", "seen_doc"))
        if n < longest:
            shorter = frequent_filter(_prints(grams, n))
    phrases = single.select("lang", F.lit(1).alias("n_words"), F.col("word").alias("phrase"), "count", "seen_doc")
    if levels:
        each = reduce(DataFrame.unionAll, levels).select("*", F.posexplode("names").alias("at", "name"))
        spelled = each.join(single.select("name", "lang", "word"), "name").groupBy("names", "count", "seen_doc").agg(
            F.first("lang").alias("lang"), F.sort_array(F.collect_list(F.struct("at", "word"))).alias("words"))
        phrases = phrases.unionAll(spelled.select(
            "lang", F.size("names").alias("n_words"), F.array_join("words.word", " ").alias("phrase"), "count", "seen_doc"))
    totals = words.groupBy("lang").agg(F.sum("count").alias("count")).select(
        "lang", F.lit(0).alias("n_words"), F.lit("").alias("phrase"), "count", F.lit(None).cast("bigint").alias("seen_doc"))
    return written(phrases.unionAll(totals))


def _part(first: Column | int, count: Column | int) -> Column:
    return F.array_join(F.slice("words", first, count), " ")


def collocations(
    docs: DataFrame, least: int = 30, longest: int = 4, top: int = 2000, absorbed: int = 80, chunk: int = CHUNK,
) -> DataFrame:
    """Each language's best `top` phrases of 2 to `longest` words: lang, rank, phrase, a, l, r, n, score, seen_doc.

    Of all cuts of a phrase into two parts the lowest floor(2000000 a / (l + r)) counts, the smallest cut among equals.
    Phrases inside a longer candidate of at least `absorbed` percent of their count are left out. Exact throughout. Texts
    without words, empty tables and languages without frequent phrases give no rows; null texts are empty, repeated rows
    count each; of `docs` only doc_id, text and lang are read."""
    counts = phrase_counts(docs, least, longest, chunk)
    totals = counts.filter("n_words = 0").select("lang", F.col("count").alias("n"))
    f = counts.filter("n_words > 0")
    some = f.filter("n_words > 1").select(
        "lang", "phrase", "seen_doc", F.col("count").alias("a"), F.split("phrase", " ").alias("words"))
    cuts = some.select("lang", "phrase", "a", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"), "words").select(
        "lang", "phrase", "a", "k", _part(F.lit(1), F.col("k")).alias("head"),
        _part(F.col("k") + 1, F.size("words") - F.col("k")).alias("rest"))
    parts = f.select("lang", "phrase", "count")
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("head"), F.col("count").alias("l")), ["lang", "head"]).join(
        parts.select("lang", F.col("phrase").alias("rest"), F.col("count").alias("r")), ["lang", "rest"])
    # decimals, since products may pass 64 bits; `div` is exact on them
    score = F.expr("cast(a as decimal(20, 0)) * cast(2000000 as decimal(7, 0)) div cast(l + r as decimal(20, 0))")
    best = cuts.withColumn("score", score).groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inner = some.filter(F.size("words") > 2).select(
        "lang", "a", "words", F.explode(F.sequence(F.lit(2), F.size("words") - 1)).alias("size")).select(
        "lang", "a", "words", "size", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("size") + 1)).alias("at"))
    longer = inner.groupBy("lang", _part(F.col("at"), F.col("size")).alias("phrase")).agg(F.max("a").alias("longer"))
    kept = some.join(longer, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (F.col("longer").cast("decimal(20,0)") * 100 < F.col("a").cast("decimal(20,0)") * absorbed))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.join(best, ["lang", "phrase"]).select("lang", "phrase", "a", "cut.*", "seen_doc").withColumn(
        "rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score", "seen_doc")


@query("op13_collocations")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))
