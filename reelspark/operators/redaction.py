"""Privacy-redaction intervals.

A video has at most as many case intervals as its table has start/end column pairs, so everything except
the frame stamping is an expression over one row: the intervals travel as a short array and no shuffle is
needed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from reelspark.constants import TAIL_SECONDS
from reelspark.functions import hms_to_seconds

PAIRS = 3


def redaction_source(mp4: DataFrame, times: DataFrame) -> DataFrame:
    """Interval rows joined to every camera of their case, ordered."""
    keys = ["recording_date", "case_no"]
    return mp4.filter(F.col("path").isNotNull()).join(times, keys).orderBy(*keys, "camera_name")


def redaction_candidates(df: DataFrame, pairs: int = PAIRS) -> DataFrame:
    """Rows with a path and at least one interval value."""
    columns = [f"{side}_{i}" for i in range(1, pairs + 1) for side in ("start", "end")]
    return df.filter(F.col("path").isNotNull()).dropna(how="all", subset=columns)


def _raw_ranges(pairs: int) -> Column:
    """Pairs with both ends as array<struct<case_no, start, end>>."""
    entries = [
        F.struct(
            F.lit(i).alias("case_no"), F.col(f"start_{i}").cast("string").alias("start"),
            F.col(f"end_{i}").cast("string").alias("end"),
        )
        for i in range(1, pairs + 1)
    ]
    return F.filter(F.array(*entries), lambda r: r["start"].isNotNull() & r["end"].isNotNull())


def unpivot_ranges(df: DataFrame, keep: list[str], pairs: int = PAIRS) -> DataFrame:
    """One row per interval; a pair with a missing end is skipped."""
    return df.select(*keep, F.inline(_raw_ranges(pairs)))


def _judged(pairs: int, duration: Column) -> Column:
    """Intervals in seconds with a reject_reason; `end` means the video's end, a late end is clamped."""

    def judge(r: Column) -> Column:
        start = hms_to_seconds(r["start"])
        end = F.when(F.lower(r["end"]) == "end", duration).otherwise(hms_to_seconds(r["end"]))
        reason = (
            F.when(start.isNull() | end.isNull(), "unreadable").when(start >= end, "empty")
            .when(start > duration, "after_video")
        )
        return F.struct(
            r["case_no"].alias("case_no"), start.alias("start_s"), F.least(end, duration).alias("end_s"),
            (end > duration).alias("clamped"), reason.alias("reject_reason"),
        )

    return F.transform(_raw_ranges(pairs), judge)


def validate_ranges(df: DataFrame, keep: list[str], duration: str = "duration_s", pairs: int = PAIRS) -> DataFrame:
    """Every interval with its seconds and the reason it is rejected for (NULL when valid)."""
    return df.select(*keep, F.inline(_judged(pairs, F.col(duration))))


def with_valid_ranges(df: DataFrame, duration: str = "duration_s", pairs: int = PAIRS) -> DataFrame:
    """Add `ranges` (valid intervals by start) and `trimmed_s` (duration cut to one hour after the last one)."""
    good = F.filter(_judged(pairs, F.col(duration)), lambda r: r["reject_reason"].isNull())
    slim = F.transform(good, lambda r: F.struct(r["start_s"], r["case_no"], r["end_s"]))
    return df.withColumn("ranges", F.array_sort(slim)).withColumn("trimmed_s", trim_duration("ranges", duration))


def trim_duration(ranges: str, duration: str) -> Column:
    last = F.try_element_at(F.col(ranges), F.lit(-1))["end_s"]
    cut = F.col(duration) - last > TAIL_SECONDS
    return F.when(cut, last + TAIL_SECONDS).otherwise(F.col(duration))


def _nth(i: Column) -> Column:
    return F.try_element_at(F.col("ranges"), i)


def _black() -> Column:
    """Complement of the intervals: lead, positive gaps to the previous interval, tail."""
    lead = F.struct(F.lit(0.0).alias("start_s"), _nth(F.lit(1))["start_s"].alias("end_s"))
    gaps = F.transform(
        F.col("ranges"), lambda r, i: F.struct(r["end_s"].alias("start_s"), _nth(i + 2)["start_s"].alias("end_s"))
    )
    tail = F.struct(_nth(F.lit(-1))["end_s"].alias("start_s"), F.col("trimmed_s").alias("end_s"))
    all_periods = F.concat(F.array(lead), gaps, F.array(tail))
    return F.filter(all_periods, lambda p: p["end_s"] > p["start_s"])


def black_periods(videos: DataFrame, keep: list[str]) -> DataFrame:
    """Hidden periods of videos prepared by `with_valid_ranges`; a video without intervals has none."""
    return videos.select(*keep, F.inline(_black()))


def black_segments(videos: DataFrame, keep: list[str], duration: str = "duration_s") -> DataFrame:
    """Minutes hidden before and after each case: inner gaps are halved, the tail is at most an hour."""

    def segment(r: Column, i: Column) -> Column:
        before, after = _nth(F.when(i > 0, i)), _nth(i + 2)
        pre = F.when(i == 0, r["start_s"]).otherwise((r["start_s"] - before["end_s"]) / 2)
        tail = F.least(F.col(duration), r["end_s"] + TAIL_SECONDS) - r["end_s"]
        post = F.when(after.isNull(), tail).otherwise((after["start_s"] - r["end_s"]) / 2)
        return F.struct(
            r["case_no"].alias("case_no"), (pre / 60).alias("pre_black_segment"),
            (post / 60).alias("post_black_segment"),
        )

    return videos.select(*keep, F.inline(F.transform(F.col("ranges"), segment)))


def redaction_coverage(videos: DataFrame, keep: list[str]) -> DataFrame:
    """Visible and hidden seconds and their percent of the trimmed duration; overlapping cases count twice."""

    def total(spans: Column) -> Column:
        return F.aggregate(spans, F.lit(0.0), lambda acc, r: acc + r["end_s"] - r["start_s"])

    # videos without intervals leave through the generator: a filter would be pushed down and rebuild the intervals
    row = F.struct("trimmed_s", total(F.col("ranges")).alias("case_s"), total(_black()).alias("black_s"))
    shown = videos.select(*keep, F.inline(F.when(F.size("ranges") > 0, F.array(row))))
    return shown.select(
        *keep, "trimmed_s", "case_s", "black_s",
        F.try_divide(F.col("case_s") * 100.0, F.col("trimmed_s")).alias("case_pct"),
        F.try_divide(F.col("black_s") * 100.0, F.col("trimmed_s")).alias("black_pct"),
    )


def stamp_intervals(frames: DataFrame, videos: DataFrame, video: str = "video", at: str = "t") -> DataFrame:
    """Label frames `visible` inside any interval (both ends included), else `black`.

    The interval side is one short row per video and is joined by key; nothing is compared across videos."""
    spans = videos.select(F.col(video), F.col("ranges").alias("_ranges"))
    joined = frames.join(spans, video, "left")
    inside = F.exists("_ranges", lambda r: F.col(at).between(r["start_s"], r["end_s"]))
    label = F.when(F.coalesce(inside, F.lit(False)), "visible").otherwise("black")
    return joined.select(*frames.columns, label.alias("stamp"))
