"""Window logic over groups of any size.

A plain window sorts a whole group in one task, so one camera file that holds a third of all rows
would decide the run time. The functions here cut a group into buckets of its ordering column,
summarise every bucket with a normal (map-side combined) aggregation, run the window over the few
bucket summaries, and hand each bucket what it needs from its neighbours. Rows are then windowed per
bucket, so no task sees more than one bucket of a group, and the result equals the plain window.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

BUCKET = "_bucket"
FRAME_BUCKET = 65536
SECONDS_BUCKET = 3600


def bucketed(df: DataFrame, order: str, width: float) -> DataFrame:
    return df.withColumn(BUCKET, F.floor(F.col(order) / F.lit(width)))


def carried(
    df: DataFrame,
    keys: Sequence[str],
    summaries: dict[str, Column],
    before: dict[str, Callable[[WindowSpec], Column]] | None = None,
    after: dict[str, Callable[[WindowSpec], Column]] | None = None,
) -> DataFrame:
    """For each bucket the values folded over all earlier (`before`) or later (`after`) buckets of the same group.

    Both windows run outwards from the bucket's own side: `last` is the nearest bucket in either direction."""
    group = [*keys, BUCKET]
    per_bucket = df.groupBy(*group).agg(*[c.alias(n) for n, c in summaries.items()])
    ahead = Window.partitionBy(*keys).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    behind = Window.partitionBy(*keys).orderBy(F.desc(BUCKET)).rowsBetween(Window.unboundedPreceding, -1)
    return per_bucket.select(
        *group,
        *[f(ahead).alias(n) for n, f in (before or {}).items()],
        *[f(behind).alias(n) for n, f in (after or {}).items()],
    )


def carry(
    df: DataFrame,
    keys: Sequence[str],
    summaries: dict[str, Column],
    before: dict[str, Callable[[WindowSpec], Column]] | None = None,
    after: dict[str, Callable[[WindowSpec], Column]] | None = None,
) -> DataFrame:
    """Attach what is `carried` to each bucket to its rows."""
    return df.join(carried(df, keys, summaries, before, after), [*keys, BUCKET], "left")


def inside(keys: Sequence[str], order: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*keys, BUCKET).orderBy(*order)


def with_previous(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str],
    width: float = FRAME_BUCKET, prefix: str = "prev_",
) -> DataFrame:
    """Columns of the preceding row (NULL on the first row of a group)."""
    row = F.struct(*cols)
    cut = carry(
        bucketed(df, order[0], width), keys,
        {"_edge": F.max_by(row, F.struct(*order))},
        before={"_carried": lambda w: F.last("_edge", ignorenulls=True).over(w)},
    )
    near = cut.withColumn("_near", F.coalesce(F.lag(row).over(inside(keys, order)), F.col("_carried")))
    return near.select(*df.columns, *[F.col("_near")[c].alias(prefix + c) for c in cols])


def with_next(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str],
    width: float = FRAME_BUCKET, prefix: str = "next_",
) -> DataFrame:
    """Columns of the following row (NULL on the last row of a group)."""
    row = F.struct(*cols)
    cut = carry(
        bucketed(df, order[0], width), keys,
        {"_edge": F.min_by(row, F.struct(*order))},
        after={"_carried": lambda w: F.last("_edge", ignorenulls=True).over(w)},
    )
    near = cut.withColumn("_near", F.coalesce(F.lead(row).over(inside(keys, order)), F.col("_carried")))
    return near.select(*df.columns, *[F.col("_near")[c].alias(prefix + c) for c in cols])


def with_running_sum(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, out: str,
    width: float = FRAME_BUCKET,
) -> DataFrame:
    """Sum of `value` up to and including the row."""
    staged = bucketed(df, order[0], width).withColumn("_value", value)
    cut = carry(
        staged, keys, {"_part": F.sum("_value")},
        before={"_carried": lambda w: F.sum("_part").over(w)},
    )
    running = inside(keys, order).rowsBetween(Window.unboundedPreceding, 0)
    total = F.coalesce(F.col("_carried"), F.lit(0)) + F.sum("_value").over(running)
    return cut.select(*df.columns, total.alias(out))


def with_earlier_max(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, out: str,
    width: float = SECONDS_BUCKET,
) -> DataFrame:
    """Maximum of `value` over the rows before this one (NULL on the first)."""
    staged = bucketed(df, order[0], width).withColumn("_value", value)
    cut = carry(
        staged, keys, {"_part": F.max("_value")},
        before={"_carried": lambda w: F.max("_part").over(w)},
    )
    earlier = inside(keys, order).rowsBetween(Window.unboundedPreceding, -1)
    best = F.greatest(F.col("_carried"), F.max("_value").over(earlier))
    return cut.select(*df.columns, best.alias(out))


def with_known_neighbours(
    df: DataFrame, keys: Sequence[str], order: str, cols: Sequence[str],
    width: float = FRAME_BUCKET, sides: Sequence[str] = ("before", "after"),
) -> DataFrame:
    """Nearest known value around each row as struct<at, value> with its position.

    `before`: at or before the row, `_lo_<c>`; `after`: at or after it, `_hi_<c>`; `beyond`: strictly after it,
    also `_hi_<c>`. `order` must be unique inside a group."""

    def known(c: str) -> Column:
        return F.when(F.col(c).isNotNull(), F.struct(F.col(order).alias("at"), F.col(c).alias("value")))

    staged = bucketed(df, order, width)
    ahead = "after" in sides or "beyond" in sides
    summaries, before, after = {}, {}, {}
    for c in cols:
        if "before" in sides:
            summaries[f"_max_{c}"] = F.max_by(known(c), F.when(F.col(c).isNotNull(), F.col(order)))
            before[f"_cl_{c}"] = lambda w, c=c: F.last(f"_max_{c}", ignorenulls=True).over(w)
        if ahead:
            summaries[f"_min_{c}"] = F.min_by(known(c), F.when(F.col(c).isNotNull(), F.col(order)))
            after[f"_ch_{c}"] = lambda w, c=c: F.last(f"_min_{c}", ignorenulls=True).over(w)
    cut = carry(staged, keys, summaries, before, after)
    # looking ahead is looking back in descending order: a frame that shrinks from the front would rescan its rows
    back = inside(keys, [order]).rowsBetween(Window.unboundedPreceding, 0)
    fore = Window.partitionBy(*keys, BUCKET).orderBy(F.desc(order)).rowsBetween(
        Window.unboundedPreceding, -1 if "beyond" in sides else 0
    )
    out = []
    for c in cols:
        if "before" in sides:
            near = F.last(known(c), ignorenulls=True).over(back)
            out.append(F.coalesce(near, F.col(f"_cl_{c}")).alias(f"_lo_{c}"))
        if ahead:
            near = F.last(known(c), ignorenulls=True).over(fore)
            out.append(F.coalesce(near, F.col(f"_ch_{c}")).alias(f"_hi_{c}"))
    return cut.select(*df.columns, *out)


def with_group_rank(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], spread: Column, out: str,
    start: int = 0, buckets: int = 4096, large: Column | None = None,
) -> DataFrame:
    """Dense position inside a group of any size.

    `spread` is a hex digest of the row; its leading digits cut a large group into even buckets, and the
    order inside the group is (digest, order). Where `large` tells which groups are, the others stay in one bucket."""
    digits = F.lit(max(1, len(f"{buckets - 1:x}")))
    if large is not None:
        digits = F.when(large, digits).otherwise(0)
    staged = df.withColumn("_digest", spread).withColumn(BUCKET, F.substring("_digest", F.lit(1), digits))
    cut = carry(
        staged, keys, {"_n": F.count(F.lit(1))},
        before={"_offset": lambda w: F.sum("_n").over(w)},
    )
    w = Window.partitionBy(*keys, BUCKET).orderBy("_digest", *order)
    rank = F.coalesce(F.col("_offset"), F.lit(0)) + F.row_number().over(w) - 1 + start
    return cut.select(*df.columns, rank.cast("long").alias(out))
