"""Catalogue tables: keyed upserts, change detection, differences, set operations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from reelspark.constants import RECORDING_KEY
from reelspark.functions import no_nan
from reelspark.operators.keys import one_per_key

# ---- writing ---------------------------------------------------------------------------------


def insert_rows(t: DataFrame, rows: DataFrame, generated: Sequence[str] = ()) -> DataFrame:
    """Append rows; empty text becomes NULL and generated columns are never written."""
    types = dict(t.dtypes)
    cleaned = rows.select(*[
        (F.nullif(F.col(c), F.lit("")) if dict(rows.dtypes)[c] == "string" else F.col(c)).cast(types[c]).alias(c)
        for c in t.columns if c in rows.columns and c not in generated
    ])
    return t.unionByName(cleaned, allowMissingColumns=True)


def delete_by_key(t: DataFrame, keys: DataFrame, pk: Sequence[str]) -> DataFrame:
    """Drop rows equal to a key on every key column; a table without a key is refused."""
    if not pk:
        raise ValueError("delete needs a primary key")
    return t.join(keys.select(*pk).distinct(), list(pk), "left_anti")


def upsert_managed(
    t: DataFrame, updates: DataFrame, keys: Sequence[str], managed: Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """Insert or update only the managed columns; every other column keeps its value.

    Of several updates of a key the last by `order` counts, or by the managed columns themselves."""
    wanted = [*keys, *[c for c in dict.fromkeys([*managed, *order]) if c not in keys]]
    new = one_per_key(updates.select(*wanted), keys, order).select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], *[F.col(c).alias(f"_u_{c}") for c in managed],
        F.lit(True).alias("_update"),
    )
    on = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_k_{k}") for k in keys])
    joined = t.join(new, on, "full_outer")
    hit = F.col("_update").isNotNull()

    def value(c: str) -> Column:
        if c in keys:
            return F.coalesce(F.col(c), F.col(f"_k_{c}")).alias(c)
        if c in managed:
            return F.when(hit, F.col(f"_u_{c}")).otherwise(F.col(c)).alias(c)
        return F.col(c)

    return joined.select(*[value(c) for c in t.columns])


def upsert_all(t: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full-row upsert; rows without a key are skipped, NaN becomes NULL, flags become 0/1 in number columns."""
    types = dict(t.dtypes)

    def clean(c: str, kind: str) -> Column:
        value = no_nan(c) if kind in ("double", "float") else F.col(c)
        return value.cast(types[c]).alias(c)

    rows = updates.dropna(subset=list(keys)).select(*[clean(c, k) for c, k in updates.dtypes if c in types])
    return upsert_managed(t, rows, keys, [c for c in t.columns if c not in keys and c in rows.columns])


def skipped_rows(updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of update rows whose key did not parse."""
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return updates.agg(F.count_if(missing).alias("skipped"))


CACHE_COLUMNS = ("idx_frames", "first_frame_time", "last_frame_time", "idx_file_size", "idx_cached_at")


def upsert_partial(
    t: DataFrame, updates: DataFrame, keys: Sequence[str] = RECORDING_KEY, cache: Sequence[str] = CACHE_COLUMNS
) -> DataFrame:
    """Write only the cache columns; a new row has NULL in all others until they are filled in."""
    return upsert_managed(t, updates, keys, [c for c in cache if c in updates.columns])


def update_else_insert(t: DataFrame, updates: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    return upsert_managed(t, updates, keys, cols)


def affected_counts(t: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many update rows change an existing row and how many insert one."""
    present = t.select(*keys).distinct().withColumn("_hit", F.lit(True))
    return updates.join(present, list(keys), "left").agg(
        F.count("_hit").alias("updated"), F.count_if(F.col("_hit").isNull()).alias("inserted")
    )


def update_offsets(t: DataFrame, updates: DataFrame) -> DataFrame:
    """Set camera offsets by recording key; an update that matches no row falls back to rows of the same case
    whose path contains the camera name (the last name in order wins)."""
    key = list(RECORDING_KEY)
    updates = one_per_key(updates.select(*key, "offset_seconds"), key)
    exact = updates.select(*key, F.col("offset_seconds").alias("_exact"))
    unmatched = updates.join(t.select(*key).distinct(), key, "left_anti").select(
        "recording_date", "case_no", F.col("camera_name").alias("_name"), F.col("offset_seconds").alias("_offset")
    )
    by_path = (
        t.select(*key, "path").join(unmatched, ["recording_date", "case_no"])
        .filter(F.lower("path").contains(F.lower("_name")))
        .groupBy(*key).agg(F.max_by("_offset", "_name").alias("_fallback"))
    )
    joined = t.join(exact, key, "left").join(by_path, key, "left")
    offset = F.coalesce("_fallback", "_exact", "offset_seconds").alias("offset_seconds")
    return joined.select(*[offset if c == "offset_seconds" else F.col(c) for c in t.columns])


def evolve_schema(df: DataFrame, target: Mapping[str, str], obsolete: Sequence[str] = ()) -> DataFrame:
    """Add missing typed columns as NULL and drop the listed obsolete ones."""
    kept = df.drop(*obsolete)
    return kept.withColumns({c: F.lit(None).cast(t) for c, t in target.items() if c not in kept.columns})


def overwrite_partitions(df: DataFrame, path: str, partition: str = "recording_date") -> None:
    """Replace only the partitions present in `df`."""
    (
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    )


def upsert_partitions(
    spark: SparkSession, path: str, updates: DataFrame, keys: Sequence[str], managed: Sequence[str],
    partition: str = "recording_date", schema: str | None = None,
) -> None:
    """Managed upsert of a partitioned parquet table: reads and rewrites only the touched partitions."""
    reader = spark.read.schema(schema) if schema else spark.read
    current = touched_partitions(reader.parquet(path), updates, partition)
    overwrite_partitions(upsert_managed(current, updates, keys, managed), path, partition)


def touched_partitions(t: DataFrame, updates: DataFrame, partition: str = "recording_date") -> DataFrame:
    """Rows of `t` in the partitions that the updates touch. The partition values, of which there are at most as many as
    days, go into the plan, so that the file index leaves all other partitions out."""
    values = [r[0] for r in updates.select(partition).distinct().collect()]
    return t.filter(F.col(partition).isin([v for v in values if v is not None]))


# ---- change detection ------------------------------------------------------------------------


def classify_changes(old: DataFrame, new: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Each new row as NEW, CHANGED or UNCHANGED; NULL equals NULL, deletions are not reported."""
    before = one_per_key(old.select(*keys, *cols), keys).select(*keys, *[F.col(c).alias(f"_o_{c}") for c in cols], F.lit(True).alias("_known"))
    joined = new.select(*keys, *cols).join(before, list(keys), "left")
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_o_{c}")) for c in cols])
    status = F.when(F.col("_known").isNull(), "NEW").when(same, "UNCHANGED").otherwise("CHANGED")
    return joined.select(*keys, *cols, status.alias("change"))


def change_counts(old: DataFrame, new: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    return classify_changes(old, new, keys, cols).groupBy("change").agg(F.count(F.lit(1)).alias("n"))


def next_key(t: DataFrame, key: str) -> DataFrame:
    """Largest key plus one; an empty table or a zero maximum gives 1."""
    return t.agg((F.coalesce(F.nullif(F.max(key), F.lit(0)), F.lit(0)) + 1).cast("long").alias("next_key"))


def diff_tables(
    a: DataFrame, b: DataFrame, keys: Sequence[str], last_by: Sequence[str] = ()
) -> DataFrame:
    """Keys of two tables as only_a, only_b, differs or same. NULL equals NULL.

    Key columns absent from either table are ignored; without any, the whole row is the key and nothing can
    differ. Of duplicate keys the last row in the order of `last_by` counts, else the largest row."""
    shared = [c for c in a.columns if c in b.columns]
    on = [k for k in keys if k in shared] or shared
    rest = [c for c in shared if c not in on]

    def side(t: DataFrame, tag: str) -> DataFrame:
        row = F.struct(*rest) if rest else F.lit(True)
        order = F.struct(*last_by, *rest) if last_by else row
        last = F.max_by(row, order)
        return t.groupBy(*on).agg(last.alias("_row"), F.lit(True).alias("_in")).select(
            *[F.col(k).alias(f"_{tag}_{k}") for k in on],
            F.col("_row").alias(f"_{tag}_row"), F.col("_in").alias(f"_{tag}_in"),
        )

    match = reduce(lambda x, y: x & y, [F.col(f"_a_{k}").eqNullSafe(F.col(f"_b_{k}")) for k in on])
    joined = side(a, "a").join(side(b, "b"), match, "full_outer")
    result = (
        F.when(F.col("_b_in").isNull(), "only_a").when(F.col("_a_in").isNull(), "only_b")
        .when(F.col("_a_row").eqNullSafe(F.col("_b_row")), "same").otherwise("differs")
    )
    return joined.select(
        *[F.when(F.col("_a_in").isNotNull(), F.col(f"_a_{k}")).otherwise(F.col(f"_b_{k}")).alias(k) for k in on],
        result.alias("result"),
    )


def skip_known(scan: DataFrame, table: DataFrame, keys: Sequence[str] = RECORDING_KEY) -> DataFrame:
    """Rows whose key is not in the table yet; rows whose key did not parse are kept."""
    return scan.join(table.select(*keys).distinct(), list(keys), "left_anti")


def normalise_path(path: Column) -> Column:
    """One separator, no empty or `.` components."""
    slashed = F.regexp_replace(path, r"[\\/]+", "/")
    return F.regexp_replace(slashed, r"/\.(?=/|$)", "")


def skip_processed(df: DataFrame, state: DataFrame, path: str = "path") -> DataFrame:
    """Flag the rows whose path is already in the processed state."""
    done = state.select(normalise_path(F.col("path")).alias("_done")).distinct()
    joined = df.withColumn("_norm", normalise_path(F.col(path))).join(done, F.col("_norm") == F.col("_done"), "left")
    return joined.select(*df.columns, F.col("_done").isNotNull().alias("processed"))


def missing_on_other(
    here: DataFrame, other: DataFrame, keys: Sequence[str] = RECORDING_KEY
) -> DataFrame:
    """Keys with a size on this side and none on the other."""
    present = other.filter(F.col("size_mb").isNotNull()).select(*keys).distinct()
    return here.filter(F.col("size_mb").isNotNull()).select(*keys).distinct().join(present, list(keys), "left_anti")


def missing_mp4(seq: DataFrame, mp4: DataFrame, per_case: bool = False) -> DataFrame:
    return missing_on_other(seq, mp4, RECORDING_KEY[:2] if per_case else RECORDING_KEY)


def missing_seq(seq: DataFrame, mp4: DataFrame, per_case: bool = False) -> DataFrame:
    return missing_on_other(mp4, seq, RECORDING_KEY[:2] if per_case else RECORDING_KEY)


def seniority(people: DataFrame, details: DataFrame) -> DataFrame:
    """Completed months from the start date to the recording, and resident or attending by the grade date."""
    who = people.select("anesthesiology_key", "name", "anesthesiology_start_date", "grade_a_date")
    joined = details.join(who, "anesthesiology_key", "left")
    on = F.to_date("recording_date")
    start = F.to_date("anesthesiology_start_date")
    months = (
        (F.year(on) - F.year(start)) * 12 + F.month(on) - F.month(start)
        - F.when(F.day(on) < F.day(start), 1).otherwise(0)
    )
    level = F.when(F.to_date("grade_a_date") <= on, "attending").when(start.isNotNull(), "resident")
    return joined.select(
        "recording_date", "case_no", "anesthesiology_key", "name",
        months.alias("months_anesthetic_recording"), level.alias("anesthetic_attending"),
    )


# ---- summaries -------------------------------------------------------------------------------


def table_summary(t: DataFrame) -> DataFrame:
    return t.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.coalesce(F.sum("size_mb"), F.lit(0)).cast("long").alias("total_size"),
        F.countDistinct("recording_date").alias("dates"),
        F.countDistinct("recording_date", "case_no").alias("cases"),
        F.countDistinct("camera_name").alias("cameras"),
    )


def compare_summaries(a: DataFrame, b: DataFrame) -> DataFrame:
    """Summary of two catalogues side by side with the difference b − a, one row per measure."""

    def long(t: DataFrame, tag: str) -> DataFrame:
        one = table_summary(t)
        return one.unpivot([], one.columns, "measure", "value").withColumn("side", F.lit(tag))

    both = long(a, "a").unionByName(long(b, "b")).groupBy("measure").agg(
        F.max(F.when(F.col("side") == "a", F.col("value"))).alias("a"),
        F.max(F.when(F.col("side") == "b", F.col("value"))).alias("b"),
    )
    return both.withColumn("difference", F.col("b") - F.col("a"))


def key_values(t: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct non-NULL values of each key column, sorted, as (column, value) rows."""
    texts = t.select(*[F.col(k).cast("string").alias(k) for k in keys])
    long = texts.unpivot([], list(keys), "key_column", "value").filter(F.col("value").isNotNull())
    return long.distinct().orderBy("key_column", "value")


def keys_only_in(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    return a.select(*keys).subtract(b.select(*keys))


def keys_common(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    return a.select(*keys).intersect(b.select(*keys))


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key in the stated order; combined map-side, so a frequent key stays cheap."""
    rest = [c for c in df.columns if c not in keys]
    first = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return first.select(*keys, *[F.col("_row")[c].alias(c) for c in rest]).select(*df.columns)


def lookup_key(t: DataFrame, key: Mapping[str, object]) -> DataFrame:
    """Rows equal to the given value on every key column."""
    return t.filter(reduce(lambda a, b: a & b, [F.col(k) == F.lit(v) for k, v in key.items()]))


def coerce_types(df: DataFrame, declared: Mapping[str, str]) -> DataFrame:
    """Text columns by declared type: DATE and TIME to ISO text, INT and REAL to numbers, blank to NULL."""

    def value(c: str) -> Column:
        text = F.nullif(F.trim(F.col(c).cast("string")), F.lit(""))
        kind = declared.get(c, "TEXT").upper()
        if "DATETIME" in kind or "TIMESTAMP" in kind:
            return F.date_format(F.try_to_timestamp(text), "yyyy-MM-dd HH:mm:ss")
        if "DATE" in kind:
            return F.date_format(F.try_to_timestamp(text), "yyyy-MM-dd")
        if "TIME" in kind:
            return F.date_format(F.try_to_timestamp(text), "HH:mm:ss")
        if "INT" in kind:
            return text.try_cast("double").cast("bigint")
        if any(k in kind for k in ("REAL", "FLOA", "DOUB")):
            return text.try_cast("double")
        return text

    return df.select(*[value(c).alias(c) for c in df.columns])


def display_columns(
    df: DataFrame, path: str | None = None, rate: str | None = None, size: str | None = None,
    minutes: str | None = None, key: bool = False, width: int = 55,
) -> DataFrame:
    """Report texts: path tail, percent, MB, minutes and `date CaseN camera`."""
    out: dict[str, Column] = {}
    if key:
        out["key_text"] = F.concat_ws(
            " ", "recording_date", F.concat(F.lit("Case"), F.col("case_no").cast("string")), "camera_name"
        )
    if path:
        out["path_text"] = F.right(F.col(path), F.lit(width))
    if rate:
        out["rate_text"] = F.format_string("%.2f%%", F.col(rate) * 100)
    if size:
        out["size_text"] = F.concat(F.col(size).cast("string"), F.lit("MB"))
    if minutes:
        out["minutes_text"] = F.format_string("%.1fmin", F.col(minutes))
    return df.select(*[c.alias(n) for n, c in out.items()])
