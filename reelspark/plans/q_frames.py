"""Queries over frame indexes and session timelines."""

from pyspark.sql import functions as F

from reelspark.constants import CAMERAS
from reelspark.operators import frames as R
from reelspark.plans import bindings as B
from reelspark.plans.registry import query, rounded


def enriched(s, d):
    return R.frame_metrics(B.frames(s, d), B.frame_rates(s, d))


@query("frame_diffs", "SELECT file, rec_no, d AS frame_diff, round(td, 6) AS ts_diff FROM diffs", "diffs")
def _(s, d):
    return R.frame_diffs(B.frames(s, d)).select("file", "rec_no", "frame_diff", F.round("ts_diff", 6).alias("ts_diff"))


@query("drop_stats", """
    SELECT file, idx_frames, dropped_frames, round(drop_rate, 6) AS drop_rate, first_frame_no, last_frame_no, frame_span,
           n_duplicates, n_counter_resets FROM enriched""", "enriched")
def _(s, d):
    return rounded(R.drop_stats(B.frames(s, d)))


TIMING = """round(first_frame_time, 6) AS first_frame_time, round(last_frame_time, 6) AS last_frame_time,
    round(max_time_gap_ms, 3) AS max_time_gap_ms, round(actual_duration, 6) AS actual_duration,
    round(expected_duration, 6) AS expected_duration, round(time_drift_ms, 3) AS time_drift_ms"""


def timing(df):
    digits = {"first_frame_time": 6, "last_frame_time": 6, "max_time_gap_ms": 3, "actual_duration": 6,
              "expected_duration": 6, "time_drift_ms": 3}
    return df.withColumns({c: F.round(c, n) for c, n in digits.items()})


@query("timing_stats", f"SELECT file, fps, {TIMING} FROM enriched", "enriched")
def _(s, d):
    return timing(R.timing_stats(B.frames(s, d), B.frame_rates(s, d)))


@query("frame_metrics", f"""
    SELECT file, fps, idx_frames, dropped_frames, round(drop_rate, 6) AS drop_rate, first_frame_no, last_frame_no,
           frame_span, n_duplicates, n_counter_resets, {TIMING} FROM enriched""", "enriched")
def _(s, d):
    return timing(enriched(s, d)).withColumn("drop_rate", F.round("drop_rate", 6))


@query("drop_summary", """
    SELECT count(*) AS files, count(*) FILTER (dropped_frames > 0) AS files_with_drops,
           count(*) FILTER (dropped_frames = 0) AS files_without_drops,
           min(dropped_frames) FILTER (dropped_frames > 0) AS min_dropped, max(dropped_frames) FILTER (dropped_frames > 0) AS max_dropped,
           round(avg(dropped_frames) FILTER (dropped_frames > 0), 6) AS mean_dropped,
           round(max(drop_rate) FILTER (dropped_frames > 0), 6) AS max_drop_rate,
           CAST(coalesce(sum(dropped_frames), 0) AS BIGINT) AS total_dropped,
           count(*) FILTER (n_counter_resets > 0) AS files_with_resets,
           median(dropped_frames) FILTER (dropped_frames > 0) AS median_dropped
    FROM enriched""", "enriched")
def _(s, d):
    return rounded(R.drop_summary(enriched(s, d)))


@query("timing_summary", """
    SELECT metric, round(min(value), 3) AS min, round(max(value), 3) AS max, round(avg(value), 3) AS mean,
           round(stddev_samp(value), 3) AS std, round(median(value), 3) AS median
    FROM (UNPIVOT (SELECT time_drift_ms, max_time_gap_ms, actual_duration FROM enriched WHERE time_drift_ms IS NOT NULL)
          ON COLUMNS(*) INTO NAME metric VALUE value) GROUP BY 1""", "enriched")
def _(s, d):
    return rounded(R.timing_summary(enriched(s, d)), 3)


@query("value_distribution", """
    SELECT frame_number AS value, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM frames GROUP BY 1""",
       "frames")
def _(s, d):
    return rounded(R.value_distribution(B.frames(s, d), "frame_number"))


@query("group_drop_table", """
    SELECT idx_frames AS value, count(dropped_frames) AS files, CAST(sum(dropped_frames) AS BIGINT) AS total_drops,
           round(avg(dropped_frames), 6) AS mean_drops, count(*) FILTER (dropped_frames > 0) AS files_w_drops,
           round(count(*) FILTER (dropped_frames > 0) * 100.0 / count(dropped_frames), 6) AS drop_pct
    FROM enriched GROUP BY 1""", "enriched")
def _(s, d):
    return rounded(R.group_drop_table(enriched(s, d), "idx_frames"))


@query("anomalies", """
    SELECT file, dropped_frames, n_counter_resets FROM enriched WHERE dropped_frames > 0 OR n_counter_resets > 0""", "enriched")
def _(s, d):
    return R.anomalies(enriched(s, d)).select("file", "dropped_frames", "n_counter_resets")


@query("gap_outliers", """
    SELECT file, fps, round(1000 / fps, 3) AS nominal_gap_ms, round(max_time_gap_ms, 3) AS max_time_gap_ms,
           round(max_time_gap_ms * fps / 1000, 6) AS gap_ratio
    FROM enriched WHERE time_drift_ms IS NOT NULL AND max_time_gap_ms * fps / 1000 > 3
    ORDER BY max_time_gap_ms * fps / 1000 DESC, file LIMIT 20""", "enriched")
def _(s, d):
    return R.gap_outliers(enriched(s, d)).withColumns({
        "nominal_gap_ms": F.round("nominal_gap_ms", 3), "max_time_gap_ms": F.round("max_time_gap_ms", 3),
        "gap_ratio": F.round("gap_ratio", 6)})


@query("drift_outliers", """
    SELECT file, round(time_drift_ms, 3) AS time_drift_ms FROM enriched WHERE abs(time_drift_ms) > 1000
    ORDER BY abs(enriched.time_drift_ms) DESC, file LIMIT 20""", "enriched")
def _(s, d):
    return rounded(R.drift_outliers(enriched(s, d)).select("file", "time_drift_ms"), 3)


@query("validate_frame_index", """
    SELECT file, count(*) FILTER ("offset" <> prev_offset + prev_size + 8) AS bad_adjacency,
           count(*) FILTER ("offset" + size > file_size) AS beyond_file, count(*) FILTER (size <= 8) AS too_small,
           count(*) FILTER (td < 0) AS time_backwards,
           count(*) FILTER (ts_sub & 65535 > 999 OR ts_sub >> 16 > 999) AS bad_subsecond,
           CASE WHEN arg_min("offset", rec_no) = 1024 THEN 0 ELSE 1 END AS bad_first_offset,
           CASE WHEN count(*) = any_value(allocated_frames) THEN 0 ELSE 1 END AS bad_count
    FROM diffs JOIN frame_rates USING (file) GROUP BY file""", "diffs frame_rates")
def _(s, d):
    return R.validate_frame_index(B.frames(s, d), B.frame_rates(s, d))


@query("relative_timecodes", """
    SELECT file, rec_no, round((t - first_value(t) OVER (PARTITION BY file ORDER BY rec_no)) * 1000, 3) AS timecode_ms
    FROM frames""", "frames")
def _(s, d):
    return rounded(R.relative_timecodes(B.frames(s, d)).select("file", "rec_no", "timecode_ms"), 3)


@query("decode_frame_time", "SELECT file, rec_no, round(t, 6) AS ts FROM frames", "frames")
def _(s, d):
    return rounded(R.with_frame_time(B.frames(s, d)).select("file", "rec_no", "ts"), 6)


# Sessions: a file is a camera of one of many cases; its takes start and end with its frames.
CAMS_SQL = """
    SELECT strftime(make_timestamp(CAST(min(epoch_us(ts)) AS BIGINT)), '%Y-%m-%d') AS recording_date,
           CAST(user_id // 8 AS INT) AS case_no, {cam} AS camera_name,
           min(epoch_us(ts)) / 1000000.0 - CASE WHEN user_id % 10 = 3 THEN 600000000 ELSE 0 END AS t_start,
           max(epoch_us(ts)) / 1000000.0 AS t_end, count(*) AS frame_count,
           CAST(floor(max(value) * 2) AS BIGINT) AS size_mb, count(*) FILTER (event_type = 'click') AS clicks,
           sum(value) AS total
    FROM events GROUP BY user_id""".format(cam=B._camera_sql("user_id"))


def cams(s, d):
    e = B.table(s, d, "events")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    return e.groupBy("user_id").agg(
        F.date_format(F.timestamp_micros(F.min(micros)), "yyyy-MM-dd").alias("recording_date"),
        (F.min(micros) / 1000000.0 - F.when(F.col("user_id") % 10 == 3, 600000000).otherwise(0)).alias("t_start"),
        (F.max(micros) / 1000000.0).alias("t_end"), F.count(F.lit(1)).alias("frame_count"),
        F.floor(F.max("value") * 2).cast("bigint").alias("size_mb"),
        F.count_if(F.col("event_type") == "click").alias("clicks"),
    ).select(
        "recording_date", F.floor(F.col("user_id") / 8).cast("int").alias("case_no"),
        B._camera(F.col("user_id")).alias("camera_name"), "t_start", "t_end", "frame_count", "size_mb", "clicks")


def with_cams(body: str) -> str:
    return f"WITH cams AS ({CAMS_SQL}), g AS (SELECT *, {GROUP} AS sync_group FROM cams) {body}"


GROUP = """CASE WHEN camera_name IN ('Cart_Center_2', 'Cart_LT_4', 'Cart_RT_1', 'General_3') THEN 'A'
    WHEN camera_name IN ('Monitor', 'Patient_Monitor', 'Ventilator_Monitor') THEN 'B' ELSE 'solo_' || camera_name END"""
SESSION = "recording_date, case_no, sync_group"


@query("timestamp_sanity", with_cams("""
    SELECT case_no, camera_name,
           CASE WHEN t_start NOT BETWEEN 1420070400 AND 1924905600 THEN 'start_outside_epoch'
                WHEN t_end NOT BETWEEN 1420070400 AND 1924905600 THEN 'end_outside_epoch'
                WHEN t_end - t_start > 250000 THEN 'duration_too_long' END AS reject_reason,
           CAST(CASE WHEN t_start NOT BETWEEN 1420070400 AND 1924905600 THEN year(to_timestamp(t_start)) END AS INT) AS bad_year
    FROM cams"""))
def _(s, d):
    return R.timestamp_sanity(cams(s, d)).select("case_no", "camera_name", "reject_reason", "bad_year")


TIMELINE = f"""
    SELECT {SESSION}, round(min(t_start), 6) AS session_start, round(max(t_end), 6) AS session_end, count(*) AS cameras,
           round(max(t_end) - min(t_start), 6) AS duration,
           CAST(round_even((max(t_end) - min(t_start)) * 30, 0) AS BIGINT) AS output_frames
    FROM g GROUP BY {SESSION}"""


@query("session_timeline", with_cams(TIMELINE))
def _(s, d):
    return rounded(R.session_timeline(cams(s, d)), 6)


@query("session_plan", with_cams(f"""
    SELECT {SESSION}, camera_name, round(t_start - a, 6) AS pre_seconds, round(b - t_end, 6) AS post_seconds,
           CAST(round_even((t_start - a) * 30, 0) AS BIGINT) AS pre_roll_frames,
           round(CASE WHEN t_end > t_start AND frame_count > 1 THEN (frame_count - 1) / (t_end - t_start) ELSE 30 END, 9) AS source_fps,
           round(b - a, 6) AS duration, CAST(round_even((b - a) * 30, 0) AS BIGINT) AS output_frames
    FROM (SELECT *, min(t_start) OVER w AS a, max(t_end) OVER w AS b FROM g WINDOW w AS (PARTITION BY {SESSION}))"""))
def _(s, d):
    return R.session_plan(cams(s, d)).withColumns({
        "pre_seconds": F.round("pre_seconds", 6), "post_seconds": F.round("post_seconds", 6),
        "source_fps": F.round("source_fps", 9), "duration": F.round("duration", 6)})


@query("extend_timeline", with_cams(f"""
    SELECT {SESSION}, round(min(t_start), 6) AS session_start, round(max(t_end), 6) AS session_end,
           count(*) FILTER (p) AS pending_cameras, count(*) FILTER (NOT p) AS converted_cameras
    FROM (SELECT *, clicks > 12 AS p FROM g)
    WHERE p OR (sync_group NOT LIKE 'solo_%' AND size_mb >= 1 AND t_start BETWEEN 1420070400 AND 1924905600
                AND t_end BETWEEN 1420070400 AND 1924905600)
    GROUP BY {SESSION} HAVING count(*) FILTER (p) > 0"""))
def _(s, d):
    c = cams(s, d)
    return rounded(R.extend_timeline(c.filter("clicks > 12"), c.filter("clicks <= 12")), 6)


@query("pending_conversions", """
    SELECT s.recording_date, s.case_no, s.camera_name, s.size_mb, s.path
    FROM seq_status s LEFT JOIN mp4_status m USING (recording_date, case_no, camera_name)
    WHERE s.size_mb >= 50 AND (m.size_mb IS NULL OR m.size_mb < 1)""",
       "seq_status mp4_status")
def _(s, d):
    return R.pending_conversions(B.seq_status(s, d), B.mp4_status(s, d), CAMERAS)


@query("resample_cfr", """
    , f AS (SELECT file, rec_no, t, first_value(t) OVER (PARTITION BY file ORDER BY rec_no) AS t0 FROM frames),
    g AS (SELECT file, CAST(round_even((any_value(t0) - 1704067200) * 0.001, 0) AS BIGINT) AS pre,
                 CAST(round_even(2592000 * 0.001, 0) AS BIGINT) AS slots FROM f GROUP BY file),
    p AS (SELECT file, pre + CAST(round_even((t - t0) * 0.001, 0) AS BIGINT) AS slot, max(rec_no) AS rec_no
          FROM f JOIN g USING (file) WHERE pre + CAST(round_even((t - t0) * 0.001, 0) AS BIGINT) < slots GROUP BY 1, 2),
    e AS (SELECT file, unnest(range(slots)) AS slot FROM g),
    j AS (SELECT e.file, e.slot, p.rec_no AS here, last_value(p.rec_no IGNORE NULLS) OVER (PARTITION BY e.file ORDER BY e.slot) AS prev,
                 max(p.slot) OVER (PARTITION BY e.file) AS last_slot
          FROM e LEFT JOIN p ON p.file = e.file AND p.slot = e.slot)
    SELECT file, slot, CASE WHEN slot <= last_slot THEN prev END AS rec_no,
           CASE WHEN here IS NOT NULL THEN 'frame' WHEN prev IS NOT NULL AND slot <= last_slot THEN 'repeat' ELSE 'black' END AS kind
    FROM j""", "frames")
def _(s, d):
    files = B.frames(s, d).select("file").distinct()
    span = files.select("file", F.lit(1704067200.0).alias("session_start"), F.lit(1706659200.0).alias("session_end"))
    return R.resample_cfr(B.frames(s, d), span, 0.001)


RESULTS_SQL = """
    SELECT *, clicks <> 11 AS success, CAST(frame_count AS DOUBLE) * 0.013::DOUBLE AS dur, frame_count AS fr FROM g"""


def results(s, d):
    c = cams(s, d).withColumn("sync_group", R.pick_group("camera_name"))
    return c.select("recording_date", "case_no", "sync_group", "camera_name", (F.col("clicks") != 11).alias("success"),
                    (F.col("frame_count") * 0.013).alias("duration"), F.col("frame_count").alias("frames"),
                    F.substring("recording_date", 1, 4).alias("run_id"), (F.col("clicks") < 5).alias("skipped"),
                    F.col("frame_count").cast("double").alias("elapsed"))


DRIFT = """
    SELECT {keys}, camera_name, round(dur, 6) AS duration, fr AS frames, round(abs(dur - d0), 6) AS drift, abs(fr - f0) AS frame_diff,
           CASE WHEN abs(dur - d0) < 0.05 THEN 'ok' ELSE 'drift' END AS row_status, round(max(abs(dur - d0)) OVER w, 6) AS max_drift,
           CASE WHEN max(abs(dur - d0)) OVER w < 0.034 THEN 'ok' WHEN max(abs(dur - d0)) OVER w < 0.1 THEN 'marginal'
                ELSE 'failed' END AS verdict
    FROM (SELECT *, first_value(dur) OVER o AS d0, first_value(fr) OVER o AS f0, count(*) OVER (PARTITION BY {keys}) AS n
          FROM (SELECT *, left(recording_date, 4) AS run_id FROM ({res})) WHERE success
          WINDOW o AS (PARTITION BY {keys} ORDER BY case_no, camera_name, recording_date))
    WHERE n >= 2 WINDOW w AS (PARTITION BY {keys})"""


@query("drift_to_first", with_cams(DRIFT.format(keys=SESSION, res=RESULTS_SQL)))
def _(s, d):
    return rounded(R.drift_to_first(results(s, d), "case_no"))


@query("drift_to_first_of_run", with_cams(DRIFT.format(keys="run_id", res=RESULTS_SQL)))
def _(s, d):
    return rounded(R.drift_to_first(results(s, d), "case_no", scope="run"))


@query("output_drift", with_cams(f"""
    SELECT {SESSION}, camera_name, round(CAST(frame_count AS DOUBLE) * 0.013::DOUBLE, 6) AS duration, round(b - a, 3) AS expected,
           round(abs(CAST(frame_count AS DOUBLE) * 0.013::DOUBLE - (b - a)), 3) AS drift
    FROM (SELECT *, min(t_start) OVER w AS a, max(t_end) OVER w AS b FROM g WINDOW w AS (PARTITION BY {SESSION}))"""))
def _(s, d):
    out = R.output_drift(results(s, d), R.session_timeline(cams(s, d)))
    return out.withColumns({"duration": F.round("duration", 6), "expected": F.round("expected", 3), "drift": F.round("drift", 3)})


@query("batch_summary", with_cams("""
    SELECT count(*) AS total, count(*) FILTER (clicks <> 11 AND clicks >= 5) AS succeeded,
           count(*) FILTER (clicks = 11) AS failed, count(*) FILTER (clicks < 5) AS skipped,
           round(count(*) FILTER (clicks <> 11 AND clicks >= 5) * 100.0 / count(*), 6) AS success_rate,
           round(avg(frame_count) FILTER (clicks <> 11 AND clicks >= 5), 6) AS avg_seconds FROM cams"""))
def _(s, d):
    return rounded(R.batch_summary(results(s, d)))


@query("batch_failures", with_cams("SELECT recording_date, case_no, camera_name FROM cams WHERE clicks = 11"))
def _(s, d):
    return R.failures(results(s, d)).select("recording_date", "case_no", "camera_name")


SYNC_SQL = """
    , r AS (SELECT s.recording_date, s.case_no, s.camera_name, s.size_mb, m.size_mb AS mp4_size_mb,
                   s.duration_minutes > 5 AS has_idx, s.part_no % 50 <> 0 AS header_ok,
                   CASE WHEN s.duration_minutes > 5 THEN s.part_no END AS idx_frames,
                   1500000000.0 + s.part_no * 1000 - CASE WHEN s.part_no % 7 = 0 THEN 500000000 ELSE 0 END AS t_start,
                   1500000000.0 + s.part_no * 1000 + s.duration_minutes * 6000 AS t_end
            FROM seq_status s LEFT JOIN mp4_status m USING (recording_date, case_no, camera_name)),
    c AS (SELECT *, CASE WHEN mp4_size_mb >= 1 THEN 'converted' WHEN NOT header_ok THEN 'bad_header'
                         WHEN NOT has_idx AND camera_name = 'Injection_Port' THEN 'solo_without_index'
                         WHEN NOT has_idx THEN 'no_index'
                         WHEN size_mb < 50 OR coalesce(idx_frames, 0) = 0 THEN 'too_small'
                         WHEN t_start < 1420070400 OR t_end > 1924905600 OR t_end - t_start > 250000 THEN 'corrupt_timestamps'
                         WHEN size_mb < 200 THEN 'syncable_small' ELSE 'syncable' END AS reason FROM r),
    k AS (SELECT *, CASE WHEN reason = 'converted' THEN 'synced' WHEN reason LIKE 'syncable%' THEN 'will_sync'
                    ELSE 'will_not_sync' END AS sync_class FROM c)"""


def recordings(s, d):
    keys = ["recording_date", "case_no", "camera_name"]
    mp4 = B.mp4_status(s, d).select(*keys, F.col("size_mb").alias("mp4_size_mb"))
    part = F.col("part_no")
    idx = F.col("duration_minutes") > 5
    return B.seq_status(s, d).join(mp4, keys, "left").select(
        *keys, "size_mb", "mp4_size_mb", idx.alias("has_idx"), (part % 50 != 0).alias("header_ok"),
        F.when(idx, part).alias("idx_frames"),
        (1500000000.0 + part * 1000 - F.when(part % 7 == 0, 500000000).otherwise(0)).alias("t_start"),
        (1500000000.0 + part * 1000 + F.col("duration_minutes") * 6000).alias("t_end"))


@query("sync_scorecard", SYNC_SQL + """
    SELECT sync_class, reason, count(*) AS n, CAST(sum(size_mb) AS BIGINT) AS total_mb,
           round(count(*) * 100.0 / (SELECT count(*) FROM k WHERE sync_class <> 'synced'), 6) AS pct
    FROM k WHERE sync_class <> 'synced' GROUP BY ROLLUP (sync_class, reason)""", "seq_status mp4_status")
def _(s, d):
    return rounded(R.sync_scorecard(recordings(s, d)))


@query("sync_completion", SYNC_SQL + """
    SELECT count(*) AS valid, count(*) FILTER (sync_class = 'synced') AS synced, count(*) FILTER (sync_class = 'will_sync') AS syncable,
           count(*) FILTER (sync_class = 'will_not_sync') AS lost,
           round(count(*) FILTER (sync_class <> 'will_not_sync') * 100.0 / count(*), 6) AS completion_pct
    FROM k""", "seq_status mp4_status")
def _(s, d):
    return rounded(R.sync_completion(recordings(s, d)))
