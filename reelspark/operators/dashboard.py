"""Summary tables behind an archive dashboard."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from reelspark.functions import count_label, month_of, year_of


def recording_statistics(mp4: DataFrame) -> DataFrame:
    """Number of cameras with a file per case."""
    return (
        mp4.filter(F.col("size_mb").isNotNull()).groupBy("recording_date", "case_no")
        .agg(F.count(F.lit(1)).alias("cameras_count"))
    )


def recording_kpis(stats: DataFrame) -> DataFrame:
    return stats.agg(
        F.count(F.lit(1)).alias("recordings"), F.countDistinct("recording_date").alias("surgery_days"),
        F.bround(F.avg("cameras_count"), 1).alias("avg_cameras"), F.max("cameras_count").alias("max_cameras"),
        F.min("recording_date").alias("first_date"), F.max("recording_date").alias("last_date"),
    )


def camera_count_distribution(stats: DataFrame) -> DataFrame:
    counts = stats.groupBy("cameras_count").agg(F.count(F.lit(1)).alias("recordings"))
    return counts.withColumn("label", count_label("cameras_count", "cam", plural=False)).orderBy("cameras_count")


def yearly_overview(stats: DataFrame) -> DataFrame:
    return stats.groupBy(year_of("recording_date").alias("year")).agg(
        F.count(F.lit(1)).alias("recordings"), F.countDistinct("recording_date").alias("surgery_days")
    ).orderBy("year")


def cases_per_day(stats: DataFrame) -> DataFrame:
    """How many days had 1, 2, … cases."""
    per_day = stats.groupBy("recording_date").agg(F.count(F.lit(1)).alias("cases"))
    days = per_day.groupBy("cases").agg(F.count(F.lit(1)).alias("days"))
    return days.withColumn("label", count_label("cases", "case")).orderBy("cases")


def monthly_overview(stats: DataFrame) -> DataFrame:
    return stats.groupBy(month_of("recording_date").alias("month")).agg(
        F.count(F.lit(1)).alias("recordings"), F.countDistinct("recording_date").alias("surgery_days"),
        F.bround(F.avg("cameras_count"), 1).alias("avg_cameras"),
    ).orderBy("month")


def tagged_cases(labels: DataFrame, stats: DataFrame) -> DataFrame:
    """Statistics of the labelled cases; repeated labels of a case count once."""
    keys = ["recording_date", "case_no"]
    return labels.select(*keys).distinct().join(stats, keys)


def labelled_overview(tagged: DataFrame, stats: DataFrame) -> DataFrame:
    """Labelled cases, days, mean cameras and the share of surgery days with a label in whole percent."""
    rows = stats.select("recording_date", F.lit(None).cast("bigint").alias("cams")).unionByName(
        tagged.select("recording_date", F.col("cameras_count").cast("bigint").alias("cams"))
    )
    days = F.countDistinct(F.when(F.col("cams").isNotNull(), F.col("recording_date")))
    all_days = F.countDistinct("recording_date")
    return rows.agg(
        F.count("cams").alias("labelled_cases"), days.alias("labelled_days"),
        F.bround(F.avg("cams"), 1).alias("avg_cameras"),
        F.coalesce(F.bround(F.try_divide(days * 100.0, all_days), 0), F.lit(0.0)).alias("coverage_pct"),
    )


def labelled_by_month(tagged: DataFrame) -> DataFrame:
    return tagged.groupBy(month_of("recording_date").alias("month")).agg(
        F.count(F.lit(1)).alias("labelled_cases")
    ).orderBy("month")


def merge_measures(a: DataFrame, b: DataFrame, on: Sequence[str]) -> DataFrame:
    """Combine separately aggregated measures; a group must occur on both sides."""
    return a.join(b, list(on))


def case_browser(mp4: DataFrame, details: DataFrame, people: DataFrame) -> DataFrame:
    """Cases newest first with camera count, longest take in seconds and the provider's name."""
    keys = ["recording_date", "case_no"]
    cases = mp4.groupBy(*keys).agg(
        F.count("camera_name").alias("camera_count"), F.max("duration_minutes").alias("_minutes")
    )
    who = details.join(people.select("anesthesiology_key", "name"), "anesthesiology_key", "left")
    named = who.groupBy(*keys).agg(F.min("name").alias("_name"))
    return (
        cases.join(named, keys, "left")
        .select(
            *keys, F.coalesce("_name", F.lit("Unknown")).alias("provider"), "camera_count",
            F.coalesce(F.col("_minutes") * 60, F.lit(0.0)).alias("total_duration"),
        )
        .orderBy(F.desc("recording_date"), F.desc("case_no"))
    )


def newest_first(df: DataFrame) -> DataFrame:
    return df.orderBy(F.desc("recording_date"), "case_no", "camera_name")


def top_k(df: DataFrame, by: str | Column, k: int, tie: Sequence[str]) -> DataFrame:
    """The k largest rows; NULL ranks are left out and ties go to the smaller key."""
    rank = F.col(by) if isinstance(by, str) else by
    return df.filter(rank.isNotNull()).orderBy(rank.desc(), *tie).limit(k)


def bottom_k(df: DataFrame, by: str | Column, k: int, tie: Sequence[str]) -> DataFrame:
    rank = F.col(by) if isinstance(by, str) else by
    return df.filter(rank.isNotNull()).orderBy(rank.asc(), *tie).limit(k)


def head_n(df: DataFrame, order: Sequence[str | Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def keep_sorted(df: DataFrame, order: Sequence[str], globally: bool = True) -> DataFrame:
    """Stated row order, over the whole result or only inside each output file."""
    return df.orderBy(*order) if globally else df.sortWithinPartitions(*order)
