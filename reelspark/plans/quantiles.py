"""Exact quantiles with linear interpolation, by selection.

A sketch of bounded size gives, for each wanted rank, two values that surely lie on either side of it. One pass then counts
what is below, and the distinct values in between, which are few whatever the distribution; the rank is found among them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

#: The sketch's rank error is at most one part in ACCURACY of a group; brackets reach MARGIN such parts either way.
ACCURACY = 10_000
MARGIN = 2


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float], accuracy: int = ACCURACY
) -> DataFrame:
    """One row per group with a column per named probability; NULL values are ignored.

    A bracket holds about 2 MARGIN / accuracy of a group's rows and their equals, which are counted before they are ordered; up
    to 2 accuracy rows are ordered whole. A
    bracket that misses its rank would raise an error rather than give a wrong value."""
    keys = list(keys)
    names = list(probs)
    rows = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_v"))
    reach = MARGIN / accuracy
    ends = [min(1.0, max(0.0, probs[n] + side)) for n in names for side in (-reach, reach)]
    edges = {"_edges": F.percentile_approx("_v", ends, accuracy), "_total": F.count(F.lit(1)), "_lo": F.min("_v"), "_hi": F.max("_v")}
    if keys:
        bounded = rows.join(rows.groupBy(*keys).agg(*[c.alias(n) for n, c in edges.items()]), keys)
    else:
        one = rows.agg(F.struct(*[c.alias(n) for n, c in edges.items()]).alias("_s")).scalar()
        bounded = rows.withColumn("_s", one).select("_v", "_s.*")

    def bracket(i: int):
        # the ends of the distribution are known exactly; a small group is ordered as a whole
        small = F.col("_total") <= 2 * accuracy
        low = F.when(small | F.lit(ends[2 * i] <= 0), F.col("_lo")).otherwise(F.col("_edges")[2 * i])
        high = F.when(small | F.lit(ends[2 * i + 1] >= 1), F.col("_hi")).otherwise(F.col("_edges")[2 * i + 1])
        place = F.struct(F.lit(i).alias("i"), F.when(F.col("_v") >= low, F.col("_v")).alias("v"))
        return F.when(F.col("_v") <= high, place)

    # NULL stands for all values below the bracket
    met = bounded.select(*keys, "_total", F.explode(F.array_compact(F.array(*map(bracket, range(len(names)))))).alias("_p"))
    counts = met.groupBy(*keys, "_total", F.col("_p.i").alias("_i"), F.col("_p.v").alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    running = Window.partitionBy(*keys, "_i").orderBy(F.asc_nulls_first("_v")).rowsBetween(Window.unboundedPreceding, 0)
    position = F.element_at(F.array(*[F.lit(float(probs[n])) for n in names]), F.col("_i") + 1) * (F.col("_total") - 1)
    ranked = counts.withColumns({"_upto": F.sum("_n").over(running), "_pos": position})
    low, high = F.floor("_pos"), F.ceil("_pos")
    hits = ranked.filter((F.col("_upto") - F.col("_n") <= high) & (low < F.col("_upto")))
    found = hits.groupBy(*keys, "_i").agg(
        F.min("_v").alias("_low"), F.max("_v").alias("_high"), F.max(F.col("_pos") - low).alias("_frac"),
        # both ranks must lie inside: nothing of the hits below the bracket, and the last hit reaches the upper rank
        (F.bool_and(F.col("_v").isNotNull()) & (F.max("_upto") > F.max(high))).alias("_inside"))
    at = F.when(F.col("_inside"), F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_frac")).otherwise(
        F.raise_error(F.lit("a quantile bracket misses its rank")).cast("double"))
    per_name = found.select(*keys, "_i", at.alias("_at"))
    wide = per_name.groupBy(*keys) if keys else per_name.groupBy()
    return wide.agg(*[F.max(F.when(F.col("_i") == i, F.col("_at"))).alias(n) for i, n in enumerate(names)])
