"""Queries over playback sessions."""

from pyspark.sql import functions as F

from reelspark.operators import sync as Y
from reelspark.plans import bindings as B
from reelspark.plans.registry import query, rounded


@query("quarantine_invalid", """
    SELECT event_id, array_to_string(list_filter([CASE WHEN abs(offset_seconds) > 300 THEN 'offset_range' END,
               CASE WHEN position - 1 < 0 THEN 'negative_time' END, CASE WHEN case_no <= 0 THEN 'case_number' END],
               lambda v: v IS NOT NULL), ',') AS failed
    FROM sessions WHERE abs(offset_seconds) > 300 OR position - 1 < 0 OR case_no <= 0""", "sessions")
def _(s, d):
    rows = B.sessions(s, d).withColumn("position", F.col("position") - 1)
    _, rejected = Y.quarantine_invalid(rows)
    return rejected.select("event_id", F.array_join("failed_rules", ",").alias("failed"))


@query("quarantine_valid", """
    SELECT event_id, round(offset_seconds, 1) AS offset_seconds FROM sessions
    WHERE NOT (abs(offset_seconds) > 300 OR position - 1 < 0 OR case_no <= 0)""", "sessions")
def _(s, d):
    rows = B.sessions(s, d).withColumn("position", F.col("position") - 1)
    valid, _ = Y.quarantine_invalid(rows)
    return rounded(valid.select("event_id", "offset_seconds"))


@query("normalise_offsets", """
    SELECT recording_date, case_no, camera_name, offset_seconds,
           greatest(-min(offset_seconds) OVER w, 0) AS shift, round(offset_seconds + greatest(-min(offset_seconds) OVER w, 0), 6)
               AS start_seconds
    FROM mp4_status WINDOW w AS (PARTITION BY recording_date, case_no)""", "mp4_status")
def _(s, d):
    return rounded(Y.normalise_offsets(B.mp4_status(s, d)).select(
        "recording_date", "case_no", "camera_name", "offset_seconds", "shift", "start_seconds"))


@query("preferred_camera", """
    SELECT recording_date, case_no, camera_name, greatest(10, offset_seconds * 5) AS start_seconds
    FROM (SELECT *, row_number() OVER (PARTITION BY recording_date, case_no
                                       ORDER BY NOT contains(camera_name, 'Monitor'), part_no, camera_name) AS i
          FROM mp4_status WHERE size_mb IS NOT NULL) WHERE i = 1""", "mp4_status")
def _(s, d):
    cams = B.mp4_status(s, d).select(
        "recording_date", "case_no", "camera_name", F.col("part_no").alias("position"),
        (F.col("offset_seconds") * 5).alias("offset_seconds"), F.col("size_mb").isNotNull().alias("file_exists"))
    return Y.preferred_camera(cams)


@query("reference_delta", """
    , latest AS (SELECT recording_date, case_no, tick, camera_name, arg_max(position, ts) AS p, arg_max(offset_seconds, ts) AS o,
                        max(ts) AS ts, camera_name = 'click' AS is_reference
                 FROM sessions GROUP BY 1, 2, 3, 4)
    SELECT l.recording_date, l.case_no, l.tick, l.camera_name, l.p AS position, r.p AS reference, l.o AS offset_seconds,
           round(l.p - r.p + l.o, 6) AS delta,
           CASE WHEN abs(l.p - r.p + l.o) <= 0.3 THEN 'synced' ELSE 'out_of_sync' END AS status
    FROM latest l JOIN latest r ON r.is_reference AND r.recording_date = l.recording_date AND r.case_no = l.case_no
         AND r.tick = l.tick""", "sessions")
def _(s, d):
    return rounded(Y.reference_delta(B.sessions(s, d)).drop("text"))
