"""One row for each key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def one_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """The last row of each key by `order`, or, without one, by all other columns. Columns keep their place."""
    rest = [c for c in rows.columns if c not in keys]
    if not rest:
        return rows.distinct()
    last = F.max_by(F.struct(*rest), F.struct(*[c for c in order if c in rest], *rest)).alias("_last")
    return rows.groupBy(*keys).agg(last).select(*[
        F.col(c) if c in keys else F.col(f"_last.{c}").alias(c) for c in rows.columns])
