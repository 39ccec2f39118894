"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from reelspark.llm.common import written


def connected(links: DataFrame) -> DataFrame:
    """(id, component) for every id of the links (a, b): the smallest id that links reach.

    In each round a vertex moves to the neighbour, or itself, that comes first in an order drawn by hash for the round,
    and from there once more; the links are rewritten between what is left and written out. The drawn orders shrink
    chains of any numbering by a constant factor a round. At the end all moves are followed and the smallest id of each
    end is looked up. All steps are joins on keys and map-side combined minima; nothing comes to the driver."""
    edges = written(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct())
    labels = edges.select(F.col("a").alias("id")).union(edges.select("b")).distinct().withColumn("end", F.col("id"))
    turn = 0
    while not edges.isEmpty():
        both = edges.select(F.col("a").alias("s"), F.col("b").alias("t")).union(edges.select("b", "a"))
        drawn = F.struct(F.xxhash64("t", F.lit(turn)).alias("r"), "t")
        own = F.struct(F.xxhash64("s", F.lit(turn)).alias("r"), F.col("s").alias("t"))
        once = both.groupBy("s").agg(F.min(drawn).alias("m")).select("s", F.least(own, F.col("m"))["t"].alias("t"))
        then = once.select(F.col("s").alias("t"), F.col("t").alias("to"))
        moves = written(once.join(then, "t").select("s", "to"))
        a, b = (moves.select(F.col("s").alias(k), F.col("to").alias(f"to_{k}")) for k in ("a", "b"))
        moved = edges.join(a, "a").join(b, "b").select(
            F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b"))
        edges = written(moved.filter("a <> b").distinct())
        labels = labels.join(moves.withColumnRenamed("s", "end"), "end", "left").select(
            "id", F.coalesce("to", "end").alias("end"))
        turn += 1
    labels = written(labels)
    least = labels.groupBy("end").agg(F.min("id").alias("component"))
    return written(labels.join(least, "end").select("id", "component"))
