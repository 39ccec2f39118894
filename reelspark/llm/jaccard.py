"""Near-duplicate documents: an exact Jaccard join of word 5-grams with prefix filters under several token orders.

Documents that link share tokens near the front of their sets, whatever the order of the tokens, as long as it is the
same for all. The join applies such orders one after another, the cheap and weak before the dear and strong:

1. by token hash, to drop the documents that share too few front tokens with anyone (most documents);
2. by frequency among those left, rare tokens first, to drop more and to pair the rest;
3. by hash, and by hash downwards, again, now between the two documents of a pair;

and verifies the pairs that pass all. Copies of a set are one class from the start. Near copies that meet in a sorted
order of min-hashes are linked before pairs are formed, and documents that are connected already form no pairs, so a large
group of near copies costs about as many pairs as it has members that link with few.

Links only run within components. Once these stand, the links of each document are counted there exactly: a component is
dealt into blocks of sets of like size, and all pairs of two blocks are compared at once by a product of matrices, of
which only the counts leave the task."""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from reelspark.llm.common import query, space_words, table, written
from reelspark.llm.components import connected

WORDS = 5
#: Linked: 100 * shared >= 80 * united, that is at least 4/5 of either set is shared.
PER_CENT = 80
#: One token more for each so many of a set is in the front of order 1, and one more shared token is asked for.
EXTRA = 20
#: Longs of a set's parity bitmap; passes over a sorted order, and the neighbours of equal first min-hash that each
#: document meets in one.
BITMAP, PASSES, NEAR = 8, 4, 32
#: A band of set sizes is so much wider than the one below, wider than two linked sets can differ, so that links stay within
#: a band and the next. Sets and tokens of a block of one band, about; tokens of which a matrix is made at once.
BAND, BLOCK_SETS, BLOCK_TOKENS, COLUMNS = 1.26, 512, 1 << 18, 4096
#: Ids that may be sent to all tasks; beyond, the documents are joined with them by shuffles.
SENT_IDS = 1_000_000

MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]
STIR = np.uint64(29)


class WordHashes(dict):
    """64-bit hashes of words; kept for the words seen last."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 150_000:
            self.clear()
        self[word] = value = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return value


def shingles(text: str | None, memo: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's runs of WORDS words; of all its words where it has fewer; none without words."""
    words = space_words(text)
    if not words:
        return np.zeros(0, np.int64)
    h = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
    run = min(WORDS, len(h))
    x = np.full(len(h) - run + 1, run, np.uint64)
    for k in range(run):
        x ^= h[k:len(h) - run + 1 + k] * MIX[k]
        x *= MIX[(k + 2) % 5]
        x ^= x >> STIR
    return np.unique(x.view(np.int64))


def shared_least(n):
    """Tokens of a set of n that a linked set has at least."""
    return -(-n * PER_CENT // 100)


def extra(n):
    return n // EXTRA


def prefix(n):
    """Length of the front, order 1: any linked set has more than extra(n) tokens of it, or than the other's extra."""
    return n - shared_least(n) + 1 + extra(n)


def _lists(values: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0, *map(len, values)]).astype("i4")
    flat = np.concatenate(values) if values else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype("i8", copy=False)))


def _texts(batches: Iterator[pa.RecordBatch], rows: int = 200) -> Iterator[tuple[pa.Array, list[np.ndarray]]]:
    """Ids and shingles of a few documents at a time."""
    memo = WordHashes()
    with np.errstate(over="ignore"):
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                some = batch.slice(at, rows)
                yield some["doc_id"], [shingles(t, memo) for t in some["text"].to_pylist()]


def fronts(docs: DataFrame) -> DataFrame:
    """(doc_id, n, f1, f2, front): set size, a 128-bit hash of the set, and the first tokens by hash."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, sets in _texts(batches):
            prints = np.array([
                np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), "<i8") for s in sets]).reshape(-1, 2)
            sizes = [len(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(sizes, pa.int64()), pa.array(prints[:, 0]), pa.array(prints[:, 1]),
                 _lists([s[:prefix(len(s))] if len(s) else s for s in sets])], ["doc_id", "n", "f1", "f2", "front"])

    return docs.mapInArrow(cut, "doc_id bigint, n bigint, f1 bigint, f2 bigint, front array<bigint>")


def token_sets(docs: DataFrame) -> DataFrame:
    """(id, n, tokens, bits, mins): sorted token hashes, parity bitmap, and min-hashes for the sorted passes."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns = (np.arange(1, 2 * PASSES + 1, dtype=np.uint64) * MIX[1]) * MIX[0] | np.uint64(1)
        for ids, sets in _texts(batches):
            bits, mins = [], []
            for s in sets:
                u = s.view(np.uint64)
                flips = np.bincount((u >> np.uint64(7)) % np.uint64(64 * BITMAP), minlength=64 * BITMAP) & 1
                bits.append(np.packbits(flips.astype(np.uint8)).view("<i8"))
                mins.append(np.array([(u * t ^ (u >> STIR)).min().view(np.int64) for t in turns]) if len(s) else s)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array([len(s) for s in sets], pa.int64()), _lists(sets), _lists(bits), _lists(mins)],
                ["id", "n", "tokens", "bits", "mins"])

    return docs.mapInArrow(cut, "id bigint, n bigint, tokens array<bigint>, bits array<bigint>, mins array<bigint>")


def _linked(x: np.ndarray, y: np.ndarray) -> bool:
    """Exact, after the fronts by hash, upwards and downwards, have been found to meet."""
    if PER_CENT * max(len(x), len(y)) > 100 * min(len(x), len(y)):
        return False
    p, q = (len(s) - shared_least(len(s)) + 1 for s in (x, y))
    for a, b in ((x[:p], y[:q]), (x[-p:], y[-q:])):
        if not len(np.intersect1d(a, b, assume_unique=True)):
            return False
    shared = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * shared >= PER_CENT * (len(x) + len(y) - shared)


def near_in_order(sets: DataFrame, turn: int) -> DataFrame:
    """Links (a, b) between documents that stand near each other when sorted by min-hashes, another turn of them each time."""
    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: deque[tuple[int, np.ndarray]] = deque(maxlen=NEAR)
        first = None
        for batch in batches:
            links = []
            tokens = batch["tokens"]
            flat, offsets = tokens.values.to_numpy(), tokens.offsets.to_numpy()
            for k, (doc, least) in enumerate(zip(batch["id"].to_pylist(), batch["m0"].to_pylist())):
                if least != first:
                    last.clear()
                    first = least
                mine = flat[offsets[k]:offsets[k + 1]].copy()
                links += [(other, doc) for other, theirs in last if _linked(theirs, mine)]
                last.append((doc, mine))
            if links:
                a, b = zip(*links)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    size = 2 * PASSES
    keys = [f"m{k}" for k in range(size)]
    order = [F.col("mins")[(2 * turn + k) % size].alias(key) for k, key in enumerate(keys)]
    rows = sets.select(*order, "id", "tokens").repartitionByRange(*keys, "id").sortWithinPartitions(*keys, "id")
    return rows.select("id", "m0", "tokens").mapInArrow(meet, "a bigint, b bigint")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) that link."""
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [(c.values.to_numpy(), c.offsets.to_numpy()) for c in (batch["x"], batch["y"])]
            keep = [
                _linked(*(flat[at[k]:at[k + 1]] for flat, at in sides)) for k in range(batch.num_rows)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    x = sets.select(F.col("id").alias("a"), F.col("tokens").alias("x"))
    y = sets.select(F.col("id").alias("b"), F.col("tokens").alias("y"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(check, "a bigint, b bigint")



def sharing_front(front: DataFrame) -> DataFrame:
    """Ids of documents that share enough tokens of their front (order 1) with others to link with any."""
    tokens = front.select("doc_id", F.explode("front").alias("token"))
    common = tokens.groupBy("token").agg(F.count("*").alias("c")).filter("c > 1").select("token")
    shared = tokens.join(common, "token").groupBy("doc_id").agg(F.count("*").alias("k"))
    # a linked set has at least 4/5 as many tokens, and so at least this extra
    asked = F.expr(f"((n * {PER_CENT} + 99) DIV 100) DIV {EXTRA} + 1")
    return front.select("doc_id", "n").distinct().join(shared, "doc_id").filter(F.col("k") >= asked).select("doc_id")


def rare_fronts(sets: DataFrame) -> DataFrame:
    """(id, n, token, at): the front of each set in the order of frequency, without tokens that no other set has.

    Sets that share less than a link takes are left out."""
    tokens = sets.select("id", F.explode("tokens").alias("token"))
    common = tokens.groupBy("token").agg(F.count("*").alias("c")).filter("c > 1")
    ranked = tokens.join(common, "token").groupBy("id").agg(
        F.array_sort(F.collect_list(F.struct("c", "token"))).alias("shared"))  # a set's own tokens, no more than its words
    ranked = sets.select("id", "n").join(ranked, "id").filter(F.expr(f"100 * size(shared) >= {PER_CENT} * n"))
    alone = F.expr("n - size(shared)")
    room = F.expr(f"n - (n * {PER_CENT} + 99) DIV 100 + 1") - alone  # tokens of no other set stand first
    front = ranked.withColumn("front", F.slice("shared", F.lit(1), F.greatest(room, F.lit(0)).cast("int")))
    out = front.select("id", "n", alone.alias("alone"), F.posexplode("front").alias("k", "x"))
    return out.select("id", "n", F.col("x.token").alias("token"), (F.col("alone") + F.col("k")).alias("at"))


def candidate_pairs(front: DataFrame, sets: DataFrame, known: DataFrame) -> DataFrame:
    """Distinct pairs (a, b) not in one component of `known` that can meet in a front by frequency and pass the filters by
    length, position and bitmap.

    In each token's list the component with most members is the chief. A member outside it is paired with the chief's
    members once, however many tokens bring the two together, and with the other outsiders of its lists. So lists whose
    members are connected but for a few make few pairs."""
    vertices = written(sets.select("id", "n", "bits").join(known, "id", "left").withColumn(
        "component", F.coalesce("component", "id")))
    rows = front.join(vertices.select("id", "component"), "id")
    sizes = rows.groupBy("token", "component").agg(F.count("*").alias("m"))
    chief = sizes.groupBy("token").agg(
        F.max_by("component", F.struct("m", "component")).alias("chief"), F.count("*").alias("parts")).filter("parts > 1")
    outside = written(rows.join(chief.select("token", "chief"), "token").filter("component <> chief"))

    apart = " + ".join(f"bit_count(x_bits[{k}] ^ y_bits[{k}])" for k in range(BITMAP))
    # shared tokens that a link of sets of these sizes takes; what is not shared differs
    wanted = f"(({PER_CENT} * (x_n + y_n) + {99 + PER_CENT}) DIV {100 + PER_CENT})"
    like = f"{PER_CENT} * greatest(x_n, y_n) <= 100 * least(x_n, y_n) AND {apart} <= x_n + y_n - 2 * {wanted}"

    def side(df: DataFrame, name: str, *keys: str) -> DataFrame:
        return df.select(*keys, *[F.col(c).alias(f"{name}_{c}") for c in df.columns if c not in keys])

    to_chief = outside.select("id", "chief").distinct().join(vertices.select("id", "n", "bits"), "id")
    members = vertices.withColumnRenamed("component", "chief")
    first = side(to_chief, "x", "chief").join(side(members, "y", "chief"), "chief").filter(like)
    loose = outside.select("token", "id", "at", "component").join(vertices.drop("component"), "id")
    second = side(loose, "x", "token").join(side(loose, "y", "token"), "token").filter(
        f"x_id < y_id AND x_component <> y_component AND least(x_n - x_at, y_n - y_at) >= {wanted} AND {like}")
    pairs = first.select("x_id", "y_id").union(second.select("x_id", "y_id"))
    return pairs.select(F.least("x_id", "y_id").alias("a"), F.greatest("x_id", "y_id").alias("b")).distinct()


def shared_counts(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """Numbers of tokens that each set of `x` shares with each of `y`."""
    out = np.zeros((len(x), len(y)), np.int64)
    sides = [(np.concatenate(s), np.repeat(np.arange(len(s)), [len(t) for t in s])) for s in (x, y)]
    common = np.intersect1d(sides[0][0], sides[1][0])
    if not len(common):
        return out
    placed = []
    for tokens, row in sides:
        at = np.minimum(np.searchsorted(common, tokens), len(common) - 1)
        there = common[at] == tokens
        order = np.argsort(at[there], kind="stable")
        placed.append((at[there][order], row[there][order]))
    (ax, rx), (ay, ry) = placed
    cx, cy = np.bincount(ax, minlength=len(common)), np.bincount(ay, minlength=len(common))
    # a column of the matrices costs as much as some pairs one by one
    dense = cx * cy * 100 > out.size
    number = np.cumsum(dense) - 1
    for first in range(0, int(dense.sum()), COLUMNS):
        parts = []
        for at, row, count in ((ax, rx, len(x)), (ay, ry, len(y))):
            mine = dense[at] & (number[at] >= first) & (number[at] < first + COLUMNS)
            m = np.zeros((count, COLUMNS), "f4")  # counts stay far below 2 ** 24
            m[row[mine], number[at[mine]] - first] = 1
            parts.append(m)
        out += (parts[0] @ parts[1].T).astype(np.int64)
    # the others: each place of a token in x with all its places in y
    few = np.flatnonzero(~dense[ax])
    start = np.cumsum(cy) - cy
    ends = np.cumsum(cy[ax[few]])
    done = 0
    while done < len(few):
        stop = max(done + 1, int(np.searchsorted(ends, (ends[done - 1] if done else 0) + (1 << 20), "right")))
        some = few[done:stop]
        n = cy[ax[some]]
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        cells = np.repeat(rx[some], n) * len(y) + ry[np.repeat(start[ax[some]], n) + step]
        out += np.bincount(cells, minlength=out.size).reshape(out.shape)
        done = stop
    return out


def degrees(sets: DataFrame, components: DataFrame) -> DataFrame:
    """(id, links): with how many other ids of its component (id, component) each id of `sets` links, exactly; ids without
    links are left out. An id with several sets links by any of them."""
    rows = components.join(sets.select("id", "n", "tokens"), "id").dropDuplicates(["id", "n", "tokens"])
    several = sets.select("id", "n", "tokens").distinct().groupBy("id").agg(F.count("*").alias("c")).filter("c > 1").select(
        "id", F.lit(True).alias("several"))
    rows = rows.join(several, "id", "left").withColumn("several", F.coalesce("several", F.lit(False)))
    rows = written(rows.withColumn("band", F.floor(F.log(BAND, F.col("n"))).cast("int")))
    cells = written(rows.groupBy("component", "band").agg(F.greatest(
        F.count("*") / BLOCK_SETS, F.sum("n") / BLOCK_TOKENS).cast("int").alias("blocks")).withColumn("blocks", F.expr("blocks + 1")))
    below, above = (cells.select("component", (F.col("band") + k).alias("band"), F.col("blocks").alias(name))
                    for k, name in ((1, "below"), (-1, "above")))
    cells = cells.join(below, ["component", "band"], "left").join(above, ["component", "band"], "left")
    few = cells.count() <= SENT_IDS
    dealt = rows.join(F.broadcast(cells) if few else cells, ["component", "band"])
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("id", F.lit(1)), F.col("blocks")))
    # both sides of a tile: (lower band, upper or not, block of the lower, block of the upper)
    tiles = F.expr("""concat(
        transform(sequence(0L, blocks - 1L), q -> struct(band AS low, false AS up, least(block, q) AS p, greatest(block, q) AS q)),
        if(above IS NULL, array(), transform(sequence(0L, above - 1L), q -> struct(band AS low, true AS up, block AS p, q AS q))),
        if(below IS NULL, array(), transform(sequence(0L, below - 1L), q -> struct(band - 1 AS low, true AS up, q AS p, block AS q))))""")
    dealt = dealt.select("component", F.explode(tiles).alias("t"), "id", "n", "tokens", "several", "band", "block")

    def count(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        up, low, p, q = (group[c][0].as_py() for c in ("up", "low", "p", "q"))
        ids, many = group["id"].to_numpy(), group["several"].to_numpy()
        tokens = group["tokens"].combine_chunks()
        flat, offsets = tokens.values.to_numpy(), tokens.offsets.to_numpy()
        right = group["band"].to_numpy() != low if up else group["block"].to_numpy() == q
        same = not up and p == q
        i, j = (np.arange(len(ids)),) * 2 if same else (np.flatnonzero(~right), np.flatnonzero(right))
        empty = np.zeros(0, np.int64)
        found = [(empty, empty, empty)]
        if len(i) and len(j):
            lists = [flat[a:b] for a, b in zip(offsets, offsets[1:])]
            x, y = [lists[k] for k in i], [lists[k] for k in j]
            shared = shared_counts(x, y)
            united = np.array([len(s) for s in x])[:, None] + np.array([len(s) for s in y]) - shared
            link = (100 * shared >= PER_CENT * united) & (ids[i][:, None] != ids[j])
            pair = link & (many[i][:, None] | many[j])
            link &= ~pair
            for mine, n in ((ids[i], link.sum(1)),) if same else ((ids[i], link.sum(1)), (ids[j], link.sum(0))):
                found.append((mine[n > 0], np.full((n > 0).sum(), -1), n[n > 0]))
            a, b = np.nonzero(pair)
            for mine, other in ((ids[i][a], ids[j][b]), (ids[j][b], ids[i][a])):
                found.append((mine, other, np.zeros(len(mine), np.int64)))
        columns = [np.concatenate(c) for c in zip(*found)]
        return pa.table({"id": columns[0], "other": columns[1], "links": columns[2]})

    found = written(dealt.select("component", "t.*", "id", "n", "tokens", "several", "band", "block").groupBy(
        "component", "low", "up", "p", "q").applyInArrow(count, "id bigint, other bigint, links bigint"))
    pairs = found.filter("links = 0").select("id", "other").distinct().select("id", F.lit(1).cast("bigint").alias("links"))
    return found.filter("links > 0").select("id", "links").union(pairs).groupBy("id").agg(F.sum("links").alias("links"))


def near_duplicates(docs: DataFrame, count_links: bool = True) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links) for every row of `docs` (doc_id, text; other columns are left out).

    Two documents link when their sets of distinct word 5-grams (all words as one where they are fewer) have a Jaccard
    similarity of 0.8 or more; component_id is the smallest doc_id that links reach. n_links counts the links between
    classes of equal sets: to how many other classes a document's own is linked; it is null where they are not counted. Null and empty texts have no set and stand alone. A repeated row is a copy; rows of one doc_id with
    different texts count as one document. A null doc_id has the component of its copies, or none."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    front = written(fronts(docs))
    classes = front.filter("n > 0").groupBy("f1", "f2", "n").agg(F.min("doc_id").alias("class"))
    sharing = written(sharing_front(front.filter("n > 0 AND doc_id IS NOT NULL")).join(
        classes.select(F.col("class").alias("doc_id")), "doc_id", "left_semi").distinct())
    few = sharing.count() <= SENT_IDS
    chosen = docs.join(F.broadcast(sharing) if few else sharing, "doc_id", "left_semi")
    sets = written(token_sets(chosen))
    rare = written(rare_fronts(sets))
    left = rare.select("id").distinct()
    sets = written(sets.join(left, "id", "left_semi"))
    links = near_in_order(sets, 0)
    for turn in range(1, PASSES):
        links = links.union(near_in_order(sets, turn))
    links = written(links.distinct())
    known = connected(links)
    pairs = written(candidate_pairs(rare, sets, known))
    more = written(verified(pairs, sets))
    # components found before are vertices now
    of_a, of_b = (known.withColumnsRenamed({"id": k, "component": f"to_{k}"}) for k in ("a", "b"))
    bridges = more.join(of_a, "a", "left").join(of_b, "b", "left").select(
        F.coalesce("to_a", "a").alias("a"), F.coalesce("to_b", "b").alias("b"))
    over = connected(bridges)
    vertices = known.union(over.select("id", F.col("id").alias("component"))).groupBy("id").agg(F.min("component").alias("component"))
    merged = vertices.join(over.select(F.col("id").alias("component"), F.col("component").alias("to")), "component", "left").select(
        F.col("id").alias("class"), F.coalesce("to", "component").alias("component"))
    merged = written(merged)
    named = classes.join(merged, "class", "left")
    if count_links:
        degree = degrees(sets, merged.withColumnRenamed("class", "id")).withColumnRenamed("id", "class")
        named = named.join(degree, "class", "left")
    n_links = F.coalesce("links", F.lit(0)) if count_links else F.lit(None)
    rows = front.select("doc_id", "n", "f1", "f2").join(named, ["f1", "f2", "n"], "left")
    return rows.select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "class", "doc_id").alias("component_id"),
        n_links.cast("bigint").alias("n_links"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """Of each component the rows of its smallest doc_id; documents without words stay."""
    found = near_duplicates(docs, count_links=False)
    go = found.filter("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(go, "doc_id", "left_anti")


@query("op2_jaccard")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
