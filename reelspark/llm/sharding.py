"""Shards along a Hilbert curve through several metadata dimensions. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from reelspark.llm.common import query, table, written

SHARDS = 24
BITS = 4
#: Rows of one cell that are ordered together, about.
ORDERED = 1000


def level_of_number(c: Column, bits: int = BITS) -> Column:
    """Level 0 to 2^bits - 1 of a count, one step to each doubling from 16. Null and negative values have level 0."""
    steps = F.floor(F.log2(F.greatest(c, F.lit(0)) + 1)) - 4
    return F.coalesce(F.greatest(F.lit(0), F.least(F.lit(2**bits - 1), steps)), F.lit(0)).cast("int")


def level_of_name(c: Column, bits: int = BITS) -> Column:
    """Level 0 to 2^bits - 1 of a name, by its hash. Null counts as an empty name."""
    return F.pmod(F.crc32(F.coalesce(c, F.lit("")).cast("binary")), F.lit(2**bits)).cast("int")


def hilbert_index(levels: Sequence[Column], bits: int = BITS) -> Column:
    """Place on the Hilbert curve through the grid of the levels, each of `bits` bits.

    Levels are turned into the curve's transposed form, from the highest bit down, and their bits interleaved."""
    n = len(levels)
    x = F.struct(*[c.cast("bigint").alias(f"x{i}") for i, c in enumerate(levels)])

    def turn(state: Column, bit: Column) -> Column:
        low = bit - 1
        xs = [state[f"x{i}"] for i in range(n)]
        for i in range(n):
            swap = xs[0].bitwiseXOR(xs[i]).bitwiseAND(low)
            high = xs[i].bitwiseAND(bit) != 0
            if i:
                xs[i] = F.when(high, xs[i]).otherwise(xs[i].bitwiseXOR(swap))
            xs[0] = F.when(high, xs[0].bitwiseXOR(low)).otherwise(xs[0].bitwiseXOR(swap))
        return F.struct(*[c.alias(f"x{i}") for i, c in enumerate(xs)])

    down = F.array(*[F.lit(1 << b).cast("bigint") for b in range(bits - 1, 0, -1)])

    def gray(s: Column) -> Column:
        xs = [reduce(lambda a, i: a.bitwiseXOR(s[f"x{i}"]), range(1, k + 1), s["x0"]) for k in range(n)]
        return F.struct(*[c.alias(f"x{i}") for i, c in enumerate(xs)])

    def digits(s: Column) -> Column:
        flip = F.aggregate(down, F.lit(0).cast("bigint"), lambda t, bit: F.when(
            s[f"x{n - 1}"].bitwiseAND(bit) != 0, t.bitwiseXOR(bit - 1)).otherwise(t))
        xs = [s[f"x{i}"].bitwiseXOR(flip) for i in range(n)]
        bit = [F.shiftleft(F.shiftright(xs[i], b).bitwiseAND(F.lit(1)), b * n + n - 1 - i) for b in range(bits) for i in range(n)]
        return reduce(lambda a, c: a + c, bit)

    # one-element arrays name an intermediate value, so that it is not worked out once for each use
    turned = F.transform(F.array(F.aggregate(down, x, turn)), gray)
    return F.transform(turned, digits)[0]


def measured(docs: DataFrame, bits: int = BITS, dims: dict[str, Column] | None = None) -> DataFrame:
    """All rows and columns of `docs` with size, text_crc32, the level of each dimension (level_<dim>) and cell.

    `dims` gives the levels; by default those of lang, source and size. Null text: size 8, crc32 of no bytes. Added
    columns replace those of the same name."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.withColumns({"size": F.length(text).cast("bigint") + 8, "text_crc32": F.crc32(text)})
    dims = dims or {
        "lang": level_of_name(F.col("lang"), bits), "source": level_of_name(F.col("source"), bits),
        "size": level_of_number(F.col("size"), bits),
    }
    rows = rows.withColumns({f"level_{name}": level for name, level in dims.items()})
    return rows.withColumn("cell", hilbert_index([F.col(f"level_{name}") for name in dims], bits))


def sharded(rows: DataFrame, shards: int = SHARDS) -> DataFrame:
    """All rows and columns of `measured` rows, with shard and slot.

    Rows are ordered by their cell on the Hilbert curve, then by doc_id's hash and doc_id, and the order is cut into
    `shards` runs whose row counts differ by one at most; slot counts from 0 within a shard. A row's rank is the rows of
    earlier cells, of earlier hashed buckets of its cell, and of its bucket before it, so neither a common cell nor the
    whole table is ordered in one task. An empty table gives no rows; repeated rows take a slot each. `rows` is read
    three times, the first two without texts. User columns named shard or slot are replaced; all others keep their values."""
    kept = [F.col(c) for c in rows.columns if c.lower() not in ("shard", "slot")]
    rows = rows.select("cell", "doc_id", "text_crc32", "size", F.struct(*kept).alias("row"))
    per_cell = rows.groupBy("cell").agg(F.count("*").alias("_n"))
    before = W.orderBy("cell").rowsBetween(W.unboundedPreceding, -1)
    cells = per_cell.select(
        "cell", (F.floor(F.col("_n") / ORDERED) + 1).alias("_buckets"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(W.partitionBy(F.lit(1))).alias("_all"))
    # the grid bounds the cells: 2^(bits * dims) rows at most
    dealt = rows.join(F.broadcast(cells), "cell")
    dealt = dealt.withColumn("_bucket", F.pmod(F.xxhash64("doc_id"), F.col("_buckets")))
    sizes = dealt.groupBy("cell", "_bucket").agg(F.count("*").alias("_n"))
    earlier = W.partitionBy("cell").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    first = sizes.select("cell", "_bucket", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_first"))
    within = W.partitionBy("cell", "_bucket").orderBy("doc_id", "text_crc32", "size")
    ranked = dealt.withColumn("_k", F.row_number().over(within) - 1).join(first, ["cell", "_bucket"])
    ranked = ranked.withColumn("_rank", F.col("_before") + F.col("_first") + F.col("_k"))
    # shard s starts at rank floor(s * all / shards), in whole numbers, so that no rounding moves a cut
    placed = ranked.withColumn("shard", F.expr(f"CAST(((_rank + 1) * {shards} - 1) DIV _all AS INT)"))
    placed = placed.withColumn("slot", F.col("_rank") - F.expr(f"(shard * _all) DIV {shards}"))
    return placed.select("row.*", "shard", "slot")


def manifest(rows: DataFrame) -> DataFrame:
    """For each shard of `sharded`: rows, bytes, and the range of cells and of every level, to skip shards by."""
    levels = [c for c in rows.columns if c.startswith("level_")]
    return rows.groupBy("shard").agg(
        F.count("*").alias("rows"), F.sum("size").alias("bytes"),
        *[f(c).alias(f"{name}_{c}") for c in ["cell", *levels] for name, f in (("min", F.min), ("max", F.max))])


def shards_for(shards: DataFrame, **levels: int) -> DataFrame:
    """Rows of a manifest whose ranges hold all the given levels."""
    for name, level in levels.items():
        shards = shards.filter(F.lit(level).between(F.col(f"min_level_{name}"), F.col(f"max_level_{name}")))
    return shards


def write_shards(rows: DataFrame, path: str) -> None:
    """One folder for each shard, rows in curve order."""
    rows.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


@query("op9_sharding")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    rows = written(measured(docs).select("doc_id", "size", "text_crc32", "cell"))
    return sharded(rows).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "cell")
