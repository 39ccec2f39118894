"""Multi-camera playback alignment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from reelspark.functions import sync_status



def failed_rules(df: DataFrame) -> DataFrame:
    """Add `failed_rules`: the names of the row rules a row breaks. A rule applies when its column exists."""
    rules: dict[str, tuple[str, Column]] = {
        "offset_range": ("offset_seconds", F.abs(F.bround(F.col("offset_seconds"), 1)) > 300),
        "negative_time": ("position", F.col("position") < 0),
        "file_type": ("path", ~F.col("path").rlike(r"\.(mp4|MP4|mkv|MKV|avi|AVI)$")),
        "date_format": ("recording_date", ~F.col("recording_date").rlike(r"^\d{4}-\d{2}-\d{2}$")),
        "case_number": ("case_no", F.col("case_no") <= 0),
        "camera_count": ("camera_count", F.col("camera_count") > 9),
    }
    hits = [F.when(broken, name) for name, (needs, broken) in rules.items() if needs in df.columns]
    return df.withColumn("failed_rules", F.array_compact(F.array(*hits)))


def quarantine_invalid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rows (offset rounded to 0.1) and rejected rows with their failed rules."""
    judged = failed_rules(df)
    ok = F.size("failed_rules") == 0
    valid = judged.filter(ok).drop("failed_rules")
    if "offset_seconds" in df.columns:
        valid = valid.withColumn("offset_seconds", F.bround("offset_seconds", 1))
    return valid, judged.filter(~ok)


def normalise_offsets(cams: DataFrame) -> DataFrame:
    """Start time per camera: offsets of a case are shifted so that none is negative."""
    keys = ["recording_date", "case_no"]
    low = cams.groupBy(*keys).agg(F.greatest(-F.min("offset_seconds"), F.lit(0.0)).alias("shift"))
    return cams.join(low, keys).withColumn("start_seconds", F.col("offset_seconds") + F.col("shift"))


def preferred_camera(cams: DataFrame) -> DataFrame:
    """One existing camera per case: a monitor first, then list order; it starts at its offset, at least 10 s."""
    rank = F.struct(~F.col("camera_name").contains("Monitor"), F.col("position"), F.col("camera_name"))
    best = cams.filter("file_exists").groupBy("recording_date", "case_no").agg(
        F.min_by(F.struct("camera_name", "offset_seconds"), rank).alias("_c")
    )
    return best.select(
        "recording_date", "case_no", "_c.camera_name",
        F.greatest(F.lit(10.0), F.coalesce("_c.offset_seconds", F.lit(0.0))).alias("start_seconds"),
    )


def reference_delta(ticks: DataFrame, tolerance: float = 0.3) -> DataFrame:
    """Latest position of each camera in a tick against the reference camera in the same tick.

    Ticks without a reference position are left out."""
    keys = ["recording_date", "case_no", "tick"]
    latest = ticks.groupBy(*keys, "camera_name").agg(
        F.max_by(F.struct("position", "offset_seconds"), "ts").alias("_p"), F.max("ts").alias("ts"),
        F.max_by("is_reference", "ts").alias("is_reference"),
    ).select(*keys, "camera_name", "ts", "is_reference", "_p.*")
    reference = latest.filter("is_reference").groupBy(*keys).agg(F.max_by("position", "ts").alias("reference"))
    joined = latest.join(reference, keys)
    return joined.withColumn("_s", sync_status("position", "reference", "offset_seconds", tolerance)).select(
        *keys, "camera_name", "position", "reference", "offset_seconds", "_s.delta", "_s.status", "_s.text"
    )
