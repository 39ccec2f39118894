"""Ranges of whole numbers as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Numbers of a range that are spelled out at once.
BLOCK = 1 << 16


def explode_range(df: DataFrame, first: str | Column, last: str | Column, out: str, block: int = BLOCK) -> DataFrame:
    """A row with `out` for every whole number from `first` to `last`; none where last < first.

    A range is first cut into blocks, so no array is longer than a block or than the number of blocks, and the blocks of a
    very long range can be dealt out."""
    low, high = (F.col(c) if isinstance(c, str) else c for c in (first, last))
    kept = df.withColumns({"_first": low.cast("bigint"), "_last": high.cast("bigint")}).filter(F.col("_first") <= F.col("_last"))
    blocks = kept.withColumn("_from", F.explode(F.sequence("_first", "_last", F.lit(block).cast("bigint"))))
    ends = F.least(F.col("_from") + (block - 1), F.col("_last"))
    return blocks.withColumn(out, F.explode(F.sequence("_from", ends))).drop("_first", "_last", "_from")
