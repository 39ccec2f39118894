"""Pairwise vector work in bounded tiles.

Rows of a group are hashed into tiles of about `tile` rows. One task handles one pair of tiles with a
matrix product and returns summaries, never the pairs themselves.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, functions as F

TILE_ROWS = 1024


def with_tiles(df: DataFrame, group: str, row_id: str, tile: int = TILE_ROWS) -> DataFrame:
    """Add `_tile` (of this row) and `_tiles` (of its group)."""
    sizes = df.groupBy(group).agg(F.ceil(F.count(F.lit(1)) / F.lit(tile)).cast("int").alias("_tiles"))
    sized = df.join(sizes, group)
    return sized.withColumn("_tile", F.pmod(F.xxhash64(row_id), F.col("_tiles")).cast("int"))


def tile_pairs_within(df: DataFrame, group: str, fn: Callable, schema: str, both_orders: bool = False) -> DataFrame:
    """Run `fn(left, right, same_tile)` over the tile pairs of each group.

    Half of the pairs is enough for symmetric work; `both_orders` visits every ordered pair."""
    left_range = F.sequence(F.lit(0) if both_orders else F.col("_tile"), F.col("_tiles") - 1)
    right_range = F.sequence(F.lit(0), F.col("_tiles") - 1 if both_orders else F.col("_tile"))
    left = df.withColumn("_i", F.col("_tile")).withColumn("_j", F.explode(left_range))
    right = df.withColumn("_j", F.col("_tile")).withColumn("_i", F.explode(right_range))
    return _cogroup(left, right, [group, "_i", "_j"], fn, schema)


def tile_pairs_between(left: DataFrame, right: DataFrame, pair: list[str], fn: Callable, schema: str) -> DataFrame:
    """As above for two tiled sides that carry the pair keys; `_other` is the tile count of the other side."""
    spread = F.sequence(F.lit(0), F.col("_other") - 1)
    a = left.withColumn("_i", F.col("_tile")).withColumn("_j", F.explode(spread))
    b = right.withColumn("_j", F.col("_tile")).withColumn("_i", F.explode(spread))
    return _cogroup(a, b, [*pair, "_i", "_j"], fn, schema)


def _cogroup(left: DataFrame, right: DataFrame, keys: list[str], fn: Callable, schema: str) -> DataFrame:
    def run(key: tuple, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        return fn(key, a, b)

    # both sides may stem from one table: fresh column identities keep them apart
    a, b = (df.select(*[F.col(c).alias(c) for c in df.columns]) for df in (left, right))
    return a.groupBy(*keys).cogroup(b.groupBy(*keys)).applyInPandas(run, schema)
