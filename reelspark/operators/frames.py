"""Frame-index analytics, shared session timelines and conversion planning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from reelspark.constants import (
    CONVERTED_MIN_MB, EPOCH_MAX, EPOCH_MIN, MAX_DURATION_SECONDS, PENDING_MIN_MB, RECORDING_KEY,
    STATUS_THRESHOLD_MB, TARGET_FPS,
)
from reelspark.functions import col, decode_frame_time, half_even_frames
from reelspark.operators.assets import pick_group
from reelspark.plans.carry import with_next, with_previous
from reelspark.plans.quantiles import exact_quantiles
from reelspark.plans.runs import explode_range


def with_frame_time(frames: DataFrame) -> DataFrame:
    return frames.withColumn("ts", decode_frame_time("ts_seconds", "ts_sub"))


def frame_diffs(frames: DataFrame) -> DataFrame:
    """Difference of counter and capture time to the preceding record of the file, in record order."""
    timed = with_frame_time(frames)
    near = with_previous(timed, ["file"], ["rec_no"], ["frame_number", "ts"])
    return near.select(
        *timed.columns,
        (F.col("frame_number") - F.col("prev_frame_number")).alias("frame_diff"),
        (F.col("ts") - F.col("prev_ts")).alias("ts_diff"),
    )


def _drop_measures() -> list[Column]:
    d = F.col("frame_diff")
    dropped = F.coalesce(F.sum(F.when(d > 1, d - 1)), F.lit(0)).cast("long")
    n = F.count(F.lit(1))
    first, last = F.min_by("frame_number", "rec_no"), F.max_by("frame_number", "rec_no")
    return [
        n.alias("idx_frames"), dropped.alias("dropped_frames"), (dropped / (n + dropped)).alias("drop_rate"),
        first.alias("first_frame_no"), last.alias("last_frame_no"), (last - first).alias("frame_span"),
        F.count_if(d == 0).alias("n_duplicates"), F.count_if(d < 0).alias("n_counter_resets"),
    ]


def _timing_measures() -> list[Column]:
    return [
        F.min_by("ts", "rec_no").alias("first_frame_time"), F.max_by("ts", "rec_no").alias("last_frame_time"),
        (F.max("ts_diff") * 1000).alias("max_time_gap_ms"), F.count(F.lit(1)).alias("_n"),
    ]


def drop_stats(frames: DataFrame) -> DataFrame:
    """Per file: records, duplicates, counter resets, dropped frames and their rate, first/last counter."""
    return frame_diffs(frames).groupBy("file").agg(*_drop_measures())


def _with_expected(timing: DataFrame, fps: DataFrame) -> DataFrame:
    actual = F.col("last_frame_time") - F.col("first_frame_time")
    expected = F.when(F.col("fps") > 0, F.col("_n") / F.col("fps"))
    return (
        timing.join(fps.select("file", "fps"), "file", "left")
        .withColumn("actual_duration", actual)
        .withColumn("expected_duration", expected)
        .withColumn("time_drift_ms", (F.col("actual_duration") - F.col("expected_duration")) * 1000)
        .drop("_n")
    )


def timing_stats(frames: DataFrame, fps: DataFrame) -> DataFrame:
    """Per file: first/last time, actual and expected duration, drift and largest signed gap in ms.

    `fps` holds (file, fps); a missing or non-positive rate gives NULL expectations."""
    return _with_expected(frame_diffs(frames).groupBy("file").agg(*_timing_measures()), fps)


def frame_metrics(frames: DataFrame, fps: DataFrame) -> DataFrame:
    """Drop and timing measures together: one pass over the frames."""
    return _with_expected(frame_diffs(frames).groupBy("file").agg(*_drop_measures(), *_timing_measures()), fps)


def drop_summary(enriched: DataFrame) -> DataFrame:
    """One row: files with and without drops, drop statistics over the files that have any."""
    rows = enriched.filter(F.col("dropped_frames").isNotNull())
    some = F.col("dropped_frames") > 0
    dropped = F.when(some, F.col("dropped_frames"))
    flat = rows.agg(
        F.count(F.lit(1)).alias("files"), F.count_if(some).alias("files_with_drops"),
        F.count_if(~some).alias("files_without_drops"), F.min(dropped).alias("min_dropped"),
        F.max(dropped).alias("max_dropped"), F.avg(dropped).alias("mean_dropped"),
        F.max(F.when(some, F.col("drop_rate"))).alias("max_drop_rate"),
        F.coalesce(F.sum(dropped), F.lit(0)).alias("total_dropped"),
        F.count_if(F.col("n_counter_resets") > 0).alias("files_with_resets"),
    )
    median = exact_quantiles(rows.filter(some), [], "dropped_frames", {"median_dropped": 0.5})
    return flat.withColumn("median_dropped", median.scalar())


TIMING_METRICS = ("time_drift_ms", "max_time_gap_ms", "actual_duration")


def timing_summary(enriched: DataFrame, metrics: Sequence[str] = TIMING_METRICS) -> DataFrame:
    """Min, max, mean, median and sample deviation per timing metric of the files with timing data."""
    rows = enriched.filter(F.col("time_drift_ms").isNotNull()).select(*metrics)
    long = rows.unpivot([], list(metrics), "metric", "value").filter(F.col("value").isNotNull())
    flat = long.groupBy("metric").agg(
        F.min("value").alias("min"), F.max("value").alias("max"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
    )
    return flat.join(exact_quantiles(long, ["metric"], "value", {"median": 0.5}), "metric")


def value_distribution(df: DataFrame, column: str) -> DataFrame:
    """Count and share per non-NULL value, in value order."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(
        F.count(F.lit(1)).alias("n")
    )
    total = counts.select(F.sum("n")).scalar()
    return counts.withColumn("share", F.col("n") / total).orderBy("value")


def group_drop_table(df: DataFrame, column: str) -> DataFrame:
    """Per group value: files with drop data, total and mean drops, files with any drop and their percent."""
    d = F.col("dropped_frames")
    files, dropping = F.count(d), F.count_if(d > 0)
    return df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(
        files.alias("files"), F.sum(d).alias("total_drops"), F.avg(d).alias("mean_drops"),
        dropping.alias("files_w_drops"), F.try_divide(dropping * 100.0, files).alias("drop_pct"),
    ).orderBy("value")


def anomalies(enriched: DataFrame) -> DataFrame:
    """Files with drops or counter resets, most drops first."""
    odd = (F.col("dropped_frames") > 0) | (F.col("n_counter_resets") > 0)
    return enriched.filter(odd).orderBy(F.desc("dropped_frames"), "file")


def gap_outliers(enriched: DataFrame, ratio: float = 3.0, n: int = 20) -> DataFrame:
    """Files whose largest gap exceeds `ratio` nominal frame intervals, worst first."""
    nominal = F.when(F.col("fps") > 0, F.lit(1000.0) / F.col("fps"))
    rows = enriched.withColumn("nominal_gap_ms", nominal).withColumn(
        "gap_ratio", F.col("max_time_gap_ms") / F.col("nominal_gap_ms")
    )
    return rows.filter(F.col("time_drift_ms").isNotNull() & (F.col("gap_ratio") > ratio)).select(
        "file", "fps", "nominal_gap_ms", "max_time_gap_ms", "gap_ratio"
    ).orderBy(F.desc("gap_ratio"), "file").limit(n)


def drift_outliers(enriched: DataFrame, drift_ms: float = 1000.0, n: int = 20) -> DataFrame:
    """Files whose duration is off by more than `drift_ms`, largest first."""
    return enriched.filter(F.abs("time_drift_ms") > drift_ms).select(
        "file", "fps", "actual_duration", "expected_duration", "time_drift_ms"
    ).orderBy(F.abs("time_drift_ms").desc(), "file").limit(n)


def validate_frame_index(frames: DataFrame, headers: DataFrame) -> DataFrame:
    """Violations per integrity rule and file. `headers` holds (file, file_size, allocated_frames)."""
    timed = with_frame_time(frames)
    near = with_previous(timed, ["file"], ["rec_no"], ["offset", "size", "ts"])
    checked = near.join(headers.select("file", "file_size"), "file", "left")
    millis = F.col("ts_sub").bitwiseAND(F.lit(0xFFFF).cast("long"))
    micros = F.shiftright(F.col("ts_sub"), 16).bitwiseAND(F.lit(0xFFFF).cast("long"))
    per_file = checked.groupBy("file").agg(
        F.count_if(F.col("offset") != F.col("prev_offset") + F.col("prev_size") + 8).alias("bad_adjacency"),
        F.count_if(F.col("offset") + F.col("size") > F.col("file_size")).alias("beyond_file"),
        F.count_if(F.col("size") <= 8).alias("too_small"),
        F.count_if(F.col("ts") < F.col("prev_ts")).alias("time_backwards"),
        F.count_if((millis > 999) | (micros > 999)).alias("bad_subsecond"),
        F.when(F.min_by("offset", "rec_no") == 1024, 0).otherwise(1).alias("bad_first_offset"),
        F.count(F.lit(1)).alias("_n"),
    )
    joined = per_file.join(headers.select("file", "allocated_frames"), "file", "left")
    mismatch = F.when(F.col("_n") == F.col("allocated_frames"), 0).otherwise(1)
    return joined.withColumn("bad_count", mismatch).drop("_n", "allocated_frames")


def relative_timecodes(frames: DataFrame) -> DataFrame:
    """Milliseconds since the first record of the file."""
    timed = with_frame_time(frames)
    starts = timed.groupBy("file").agg(F.min_by("ts", "rec_no").alias("_t0"))
    return timed.join(starts, "file").select(
        "file", "rec_no", "ts", ((F.col("ts") - F.col("_t0")) * 1000).alias("timecode_ms")
    )


# ---- sessions --------------------------------------------------------------------------------


def timestamp_sanity(
    df: DataFrame, start: str = "t_start", end: str = "t_end", only_if_cached: bool = False
) -> DataFrame:
    """Add reject_reason and the offending year of implausible capture times.

    `only_if_cached` skips the test unless both times are known and non-zero."""
    a, b = F.col(start), F.col(end)

    def outside(t: Column) -> Column:
        return ~t.between(EPOCH_MIN, EPOCH_MAX)

    applies = (a.isNotNull() & b.isNotNull() & (a != 0) & (b != 0)) if only_if_cached else F.lit(True)
    reason = (
        F.when(applies & outside(a), "start_outside_epoch")
        .when(applies & outside(b), "end_outside_epoch")
        .when(applies & (b - a > MAX_DURATION_SECONDS), "duration_too_long")
    )
    bad = F.when(applies & outside(a), a).when(applies & outside(b), b)
    return df.withColumn("reject_reason", reason).withColumn("bad_year", F.year(F.timestamp_seconds(bad)))


SESSION_KEY = ("recording_date", "case_no", "sync_group")


def session_timeline(cams: DataFrame) -> DataFrame:
    """Shared start, end, duration and output frames per case and sync group."""
    grouped = cams.withColumn("sync_group", pick_group("camera_name"))
    span = grouped.groupBy(*SESSION_KEY).agg(
        F.min("t_start").alias("session_start"), F.max("t_end").alias("session_end"),
        F.count(F.lit(1)).alias("cameras"),
    )
    duration = F.col("session_end") - F.col("session_start")
    return span.withColumn("duration", duration).withColumn("output_frames", half_even_frames("duration"))


def session_plan(cams: DataFrame) -> DataFrame:
    """Per camera: padding before and after, pre-roll frames and source rate on its session timeline."""
    keyed = cams.withColumn("sync_group", pick_group("camera_name"))
    joined = keyed.join(session_timeline(cams).drop("cameras"), list(SESSION_KEY))
    own = F.col("t_end") - F.col("t_start")
    pre = F.col("t_start") - F.col("session_start")
    rate = F.when((own > 0) & (F.col("frame_count") > 1), (F.col("frame_count") - 1) / own)
    return joined.select(
        *SESSION_KEY, "camera_name", pre.alias("pre_seconds"),
        (F.col("session_end") - F.col("t_end")).alias("post_seconds"),
        half_even_frames(pre).alias("pre_roll_frames"),
        F.coalesce(rate, F.lit(float(TARGET_FPS))).alias("source_fps"),
        "duration", "output_frames",
    )


def extend_timeline(pending: DataFrame, converted: DataFrame) -> DataFrame:
    """Session spans that also cover cameras converted earlier; a solo camera is never extended and a session
    needs at least one pending camera. Implausible converted times are ignored."""
    cols = [*RECORDING_KEY, "t_start", "t_end"]
    done = (
        converted.filter(F.col("size_mb") >= CONVERTED_MIN_MB).select(*cols)
        .join(pending.select(*RECORDING_KEY), list(RECORDING_KEY), "left_anti")
        .filter(F.col("t_start").between(EPOCH_MIN, EPOCH_MAX) & F.col("t_end").between(EPOCH_MIN, EPOCH_MAX))
        .withColumn("pending", F.lit(False))
    )
    both = pending.select(*cols).withColumn("pending", F.lit(True)).unionByName(done)
    grouped = both.withColumn("sync_group", pick_group("camera_name")).filter(
        F.col("pending") | ~F.col("sync_group").startswith("solo_")
    )
    return grouped.groupBy(*SESSION_KEY).agg(
        F.min("t_start").alias("session_start"), F.max("t_end").alias("session_end"),
        F.count_if("pending").alias("pending_cameras"), F.count_if(~F.col("pending")).alias("converted_cameras"),
    ).filter("pending_cameras > 0")


def pending_conversions(seq: DataFrame, mp4: DataFrame, cameras: Sequence[str], min_mb: int = PENDING_MIN_MB) -> DataFrame:
    """Containers of useful size without a usable video, newest first."""
    done = mp4.select(*RECORDING_KEY, F.col("size_mb").alias("mp4_size_mb"))
    wanted = seq.filter(F.col("camera_name").isin(*cameras) & (F.col("size_mb") >= min_mb))
    joined = wanted.join(done, list(RECORDING_KEY), "left")
    open_rows = joined.filter(F.col("mp4_size_mb").isNull() | (F.col("mp4_size_mb") < CONVERTED_MIN_MB))
    return open_rows.select(*RECORDING_KEY, "size_mb", "path").orderBy(
        F.desc("recording_date"), "case_no", "camera_name"
    )


def resample_cfr(frames: DataFrame, sessions: DataFrame, fps: int = TARGET_FPS) -> DataFrame:
    """Map of a constant-rate output grid to source records.

    `sessions` holds (file, session_start, session_end). Slots before the camera starts and after its last
    frame are black (NULL source); a gap repeats the last record, of several records in a slot the last one
    stays. Every file gets exactly round(duration × fps) slots."""
    timed = with_frame_time(frames)
    firsts = timed.groupBy("file").agg(F.min_by("ts", "rec_no").alias("_t0"))
    grid = sessions.join(firsts, "file").select(
        "file", F.col("_t0"),
        F.rint((F.col("_t0") - F.col("session_start")) * fps).cast("long").alias("_pre"),
        F.rint((F.col("session_end") - F.col("session_start")) * fps).cast("long").alias("_slots"),
    )
    slot = F.col("_pre") + F.rint((F.col("ts") - F.col("_t0")) * fps).cast("long")
    placed = timed.join(grid, "file").select("file", "rec_no", "_slots", slot.alias("slot"))
    # a slot before the first record can only come from a clock that runs backwards
    shown = placed.filter(F.col("slot").between(0, F.col("_slots") - 1)).groupBy("file", "slot").agg(
        F.max("rec_no").alias("rec_no")
    )
    runs = with_next(shown, ["file"], ["slot"], ["slot"])
    until = F.coalesce(F.col("next_slot") - 1, F.col("slot"))
    filled = explode_range(runs.select("file", "slot", "rec_no", until.alias("_until")), "slot", "_until", "out_slot").select(
        "file", F.col("out_slot").alias("slot"), "rec_no",
        F.when(F.col("out_slot") == F.col("slot"), "frame").otherwise("repeat").alias("kind"),
    )
    ends = shown.groupBy("file").agg(F.min("slot").alias("_first"), F.max("slot").alias("_last"))
    blank = grid.filter("_slots > 0").join(ends, "file", "left").select("file", F.explode(F.filter(F.array(
        F.struct(F.lit(0).cast("long").alias("a"), (F.coalesce("_first", "_slots") - 1).alias("b")),
        F.struct((F.coalesce("_last", F.col("_slots")) + 1).alias("a"), (F.col("_slots") - 1).alias("b")),
    ), lambda r: r["a"] <= r["b"])).alias("r"))
    black = explode_range(blank, F.col("r.a"), F.col("r.b"), "slot").select(
        "file", "slot", F.lit(None).cast("bigint").alias("rec_no"), F.lit("black").alias("kind"),
    )
    return filled.unionByName(black)


def drift_to_first(results: DataFrame, order: str, scope: str = "session") -> DataFrame:
    """Duration and frame difference of each success to the first success of its session (or of the run).

    Only groups with two or more successes; the verdict of a group follows its largest drift."""
    keys = list(SESSION_KEY) if scope == "session" else ["run_id"]
    good = results.filter(F.col("success") & F.col("duration").isNotNull())
    first = good.groupBy(*keys).agg(
        F.min_by(F.struct("duration", "frames"), F.struct(order, "camera_name")).alias("_first"),
        F.count(F.lit(1)).alias("_n"),
    ).filter("_n >= 2")
    each = good.join(first, keys).withColumn("drift", F.abs(F.col("duration") - F.col("_first.duration")))
    worst = each.groupBy(*keys).agg(F.max("drift").alias("max_drift"))
    verdict = F.when(F.col("max_drift") < 0.034, "ok").when(F.col("max_drift") < 0.1, "marginal").otherwise("failed")
    return each.join(worst, keys).select(
        *keys, "camera_name", "duration", "frames", "drift",
        F.abs(F.col("frames") - F.col("_first.frames")).alias("frame_diff"),
        F.when(F.col("drift") < 0.05, "ok").otherwise("drift").alias("row_status"),
        "max_drift", verdict.alias("verdict"),
    )


def output_drift(results: DataFrame, sessions: DataFrame) -> DataFrame:
    """Distance between the probed duration of an output and its session duration."""
    expected = sessions.select(*SESSION_KEY, F.col("duration").alias("expected"))
    joined = results.join(expected, list(SESSION_KEY))
    return joined.select(
        *SESSION_KEY, "camera_name", "duration", "expected", F.abs(F.col("duration") - F.col("expected")).alias("drift")
    )


def classify_sync(recordings: DataFrame) -> DataFrame:
    """Class and first matching reason of each recording.

    Columns: camera_name, size_mb, mp4_size_mb, has_idx, header_ok, idx_frames, t_start, t_end."""
    size = F.col("size_mb")
    times_bad = ~F.col("t_start").between(EPOCH_MIN, EPOCH_MAX) | ~F.col("t_end").between(EPOCH_MIN, EPOCH_MAX)
    too_long = F.col("t_end") - F.col("t_start") > MAX_DURATION_SECONDS
    reason = (
        F.when(F.col("mp4_size_mb") >= CONVERTED_MIN_MB, "converted")
        .when(~F.col("header_ok"), "bad_header")
        .when(~F.col("has_idx") & pick_group("camera_name").startswith("solo_"), "solo_without_index")
        .when(~F.col("has_idx"), "no_index")
        .when((size < PENDING_MIN_MB) | (F.coalesce("idx_frames", F.lit(0)) == 0), "too_small")
        .when(times_bad | too_long, "corrupt_timestamps")
        .when(size < STATUS_THRESHOLD_MB, "syncable_small")
        .otherwise("syncable")
    )
    klass = (
        F.when(F.col("reason") == "converted", "synced")
        .when(F.col("reason").isin("syncable", "syncable_small"), "will_sync").otherwise("will_not_sync")
    )
    return recordings.withColumn("reason", reason).withColumn("sync_class", klass)


def sync_scorecard(recordings: DataFrame) -> DataFrame:
    """Open recordings by class and reason with subtotals: count, percent of open, size."""
    open_rows = classify_sync(recordings).filter("sync_class <> 'synced'")
    rolled = open_rows.rollup("sync_class", "reason").agg(
        F.count(F.lit(1)).alias("n"), F.sum("size_mb").cast("long").alias("total_mb")
    )
    # a handful of rows: one per class and reason
    total = F.max("n").over(Window.partitionBy(F.lit(1)))
    return rolled.withColumn("pct", F.col("n") * 100.0 / total)


def sync_completion(recordings: DataFrame) -> DataFrame:
    """Valid, synced, still syncable and reachable share in percent."""
    c = F.col("sync_class")
    counted = classify_sync(recordings).agg(
        F.count(F.lit(1)).alias("valid"), F.count_if(c == "synced").alias("synced"),
        F.count_if(c == "will_sync").alias("syncable"), F.count_if(c == "will_not_sync").alias("lost"),
    )
    return counted.withColumn(
        "completion_pct", F.try_divide((F.col("synced") + F.col("syncable")) * 100.0, F.col("valid"))
    )


def batch_summary(results: DataFrame) -> DataFrame:
    """Success, failed and skipped counts, success rate and mean time of a batch."""
    ok, skipped = F.col("success"), F.col("skipped")
    done = F.count_if(ok & ~skipped)
    return results.agg(
        F.count(F.lit(1)).alias("total"), done.alias("succeeded"), F.count_if(~ok & ~skipped).alias("failed"),
        F.count_if(skipped).alias("skipped"),
        F.try_divide(done * 100.0, F.count(F.lit(1))).alias("success_rate"),
        F.avg(F.when(ok & ~skipped, col("elapsed"))).alias("avg_seconds"),
    )


def failures(results: DataFrame) -> DataFrame:
    return results.filter(~F.col("success") & ~F.col("skipped"))
