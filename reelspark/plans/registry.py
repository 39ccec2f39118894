"""Named queries with their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from reelspark.plans.bindings import with_views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: str = "") -> Callable[[Query], Query]:
    """Register a query; `sql` is its oracle over the named fixture views."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = with_views(views, sql)
        return fn

    return add


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, since engines add floats in different orders."""
    return df.select(*[
        (F.round(F.col(c), digits) + F.lit(0.0)).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes
    ])


def load_all() -> None:
    from reelspark.plans import (  # noqa: F401
        q_assets, q_catalog, q_dashboard, q_frames, q_redaction, q_reid, q_scalars, q_streams, q_sync, q_tracks,
    )
