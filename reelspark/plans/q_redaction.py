"""Queries over redaction intervals."""

from pyspark.sql import functions as F

from reelspark.operators import redaction as X
from reelspark.plans import bindings as B
from reelspark.plans.registry import query, rounded
from reelspark.plans.spread import spread


def videos(s, d):
    return X.with_valid_ranges(B.intervals(s, d))


@query("redaction_source", """
    SELECT m.recording_date, m.case_no, m.camera_name, m.path, t.anesthesiology_key
    FROM mp4_status m JOIN details t USING (recording_date, case_no) WHERE m.path IS NOT NULL""", "mp4_status details")
def _(s, d):
    return X.redaction_source(B.mp4_status(s, d), B.details(s, d)).select(
        "recording_date", "case_no", "camera_name", "path", "anesthesiology_key")


@query("redaction_candidates", """
    SELECT video FROM intervals WHERE start_2 IS NOT NULL OR start_3 IS NOT NULL""", "intervals")
def _(s, d):
    rows = B.intervals(s, d)
    for c in ("start_1", "end_1", "end_2", "end_3"):
        rows = rows.withColumn(c, F.when(F.col("start_2").isNotNull() | F.col("start_3").isNotNull(), F.col(c)))
    return X.redaction_candidates(rows).select("video")


@query("unpivot_ranges", """
    SELECT video, 1 AS case_no, start_1 AS start, end_1 AS "end" FROM intervals
    UNION ALL SELECT video, 2, start_2, end_2 FROM intervals WHERE start_2 IS NOT NULL
    UNION ALL SELECT video, 3, start_3, end_3 FROM intervals WHERE start_3 IS NOT NULL""", "intervals")
def _(s, d):
    return X.unpivot_ranges(B.intervals(s, d), ["video"])


@query("validate_ranges", """
    SELECT video, case_no, CAST(a AS DOUBLE) AS start_s, least(b, duration_s) AS end_s, b > duration_s AS clamped,
           CASE WHEN a >= b THEN 'empty' WHEN a > duration_s THEN 'after_video' END AS reject_reason
    FROM (SELECT video, duration_s, 1 AS case_no, s1 AS a, CAST(e1 AS DOUBLE) AS b FROM intervals
          UNION ALL SELECT video, duration_s, 2, s2, CASE WHEN end_2 = 'end' THEN duration_s ELSE e2 END
          FROM intervals WHERE start_2 IS NOT NULL
          UNION ALL SELECT video, duration_s, 3, s3, CAST(e3 AS DOUBLE) FROM intervals WHERE start_3 IS NOT NULL)""",
       "intervals")
def _(s, d):
    return X.validate_ranges(B.intervals(s, d), ["video"])


@query("trim_duration", "SELECT DISTINCT video, trimmed_s FROM trimmed", "trimmed")
def _(s, d):
    return videos(s, d).filter(F.size("ranges") > 0).select("video", "trimmed_s")


PERIODS = """
    SELECT video, 0.0::DOUBLE AS start_s, start_s AS end_s FROM trimmed WHERE i = 1 AND start_s > 0
    UNION ALL SELECT video, end_s, after_start FROM trimmed WHERE i < n AND after_start > end_s
    UNION ALL SELECT video, end_s, trimmed_s FROM trimmed WHERE i = n AND trimmed_s > end_s"""


@query("black_periods", PERIODS, "trimmed")
def _(s, d):
    return X.black_periods(videos(s, d), ["video"])


@query("black_segments", """
    SELECT video, case_no, round(CASE WHEN i = 1 THEN start_s ELSE (start_s - before_end) / 2 END / 60, 6) AS pre_black_segment,
           round(CASE WHEN i = n THEN least(duration_s, end_s + 3600) - end_s ELSE (after_start - end_s) / 2 END / 60, 6)
               AS post_black_segment FROM valid""", "valid")
def _(s, d):
    return rounded(X.black_segments(videos(s, d), ["video"]))


@query("redaction_coverage", f"""
    SELECT video, trimmed_s, case_s, coalesce(black_s, 0) AS black_s, round(case_s * 100 / trimmed_s, 6) AS case_pct,
           round(coalesce(black_s, 0) * 100 / trimmed_s, 6) AS black_pct
    FROM (SELECT video, any_value(trimmed_s) AS trimmed_s, sum(end_s - start_s) AS case_s FROM trimmed GROUP BY 1)
    LEFT JOIN (SELECT video, sum(end_s - start_s) AS black_s FROM ({PERIODS}) GROUP BY 1) USING (video)""", "trimmed")
def _(s, d):
    return rounded(X.redaction_coverage(videos(s, d), ["video"]))


@query("stamp_intervals", """
    SELECT l_orderkey AS video, l_partkey AS at, count(*) AS n,
           CASE WHEN EXISTS (SELECT 1 FROM valid v WHERE v.video = l_orderkey AND l_partkey BETWEEN v.start_s AND v.end_s)
                THEN 'visible' ELSE 'black' END AS stamp
    FROM lineitem GROUP BY 1, 2""", "valid")
def _(s, d):
    frames = B.table(s, d, "lineitem").select(F.col("l_orderkey").alias("video"), F.col("l_partkey").alias("at"))
    # dealt out by video first: hardly two frames are equal, so counts made where a file is read would hold all of its rows
    counts = spread(frames, "video").groupBy("video", "at").agg(F.count(F.lit(1)).alias("n"))
    return X.stamp_intervals(counts, videos(s, d), at="at").select("video", "at", "stamp", "n")
