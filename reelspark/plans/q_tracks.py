"""Queries over detections and motion tracks."""

from pyspark.sql import functions as F

from reelspark.constants import TORSO
from reelspark.operators import tracks as K
from reelspark.plans import bindings as B
from reelspark.plans.registry import query, rounded

POINTS = [f"{k}_{p}" for k in TORSO for p in ("x", "y", "conf")]
COORDS = [c for c in POINTS if not c.endswith("_conf")]


def videos(s, d):
    """Frame counts per video: up to its last keypoint row."""
    return B.tracks(s, d).groupBy("video").agg((F.max("Frame_ID") + 1).alias("n_frames"))


@query("subsample_frames", "SELECT det_no, frame FROM dets WHERE frame % 4 = 0", "dets")
def _(s, d):
    return K.subsample_frames(B.dets(s, d), 29.9, 7).select("det_no", "frame")


@query("person_detections", "SELECT det_no, conf FROM dets WHERE cls = 0 AND conf >= 0.5", "dets")
def _(s, d):
    return K.person_detections(B.dets(s, d), 0.5).select("det_no", "conf")


@query("touching_edges", "SELECT det_no, x1 < 15 OR x2 > 85 AS touching FROM dets", "dets")
def _(s, d):
    return B.dets(s, d).select("det_no", K.touching_edges(100).alias("touching"))


@query("best_detection", """
    SELECT video, frame, det_no, conf, x1, y1, x2, y2, cls, event_type
    FROM (SELECT *, row_number() OVER (PARTITION BY video, frame ORDER BY conf DESC, det_no) AS i FROM dets
          WHERE cls = 0 AND conf >= 0.8) WHERE i = 1""", "dets")
def _(s, d):
    return K.best_detection(B.dets(s, d))


@query("pad_bbox", """
    , p AS (SELECT det_no, CAST(greatest(0, trunc(x1) - 30) AS INT) AS crop_x1, CAST(greatest(0, trunc(y1) - 30) AS INT) AS crop_y1,
                   CAST(least(60, trunc(x2) + 30) AS INT) AS crop_x2, CAST(least(120, trunc(y2) + 30) AS INT) AS crop_y2 FROM dets)
    SELECT * FROM p WHERE crop_x2 - crop_x1 >= 10 AND crop_y2 - crop_y1 >= 10""", "dets")
def _(s, d):
    return K.pad_bbox(B.dets(s, d), 60, 120).select("det_no", "crop_x1", "crop_y1", "crop_x2", "crop_y2")


def boxes(s, d):
    """Track boxes: the detections moved a little."""
    return B.dets(s, d).select(
        "video", "frame", F.col("det_no").alias("Track_ID"), (F.col("x1") + 5).alias("x1"), (F.col("y1") + 3).alias("y1"),
        (F.col("x2") + 5).alias("x2"), (F.col("y2") + 3).alias("y2"))


@query("match_tracks", """
    , t AS (SELECT video, frame, det_no AS Track_ID, x1 + 5 AS x1, y1 + 3 AS y1, x2 + 5 AS x2, y2 + 3 AS y2 FROM dets),
    o AS (SELECT t.video, t.frame, Track_ID, d.det_no, (least(t.x2, d.x2) - greatest(t.x1, d.x1)) AS w,
                 (least(t.y2, d.y2) - greatest(t.y1, d.y1)) AS h, (t.x2 - t.x1) * (t.y2 - t.y1) AS ta,
                 (d.x2 - d.x1) * (d.y2 - d.y1) AS da
          FROM t JOIN dets d ON d.video = t.video AND d.frame = t.frame AND d.cls = 0),
    r AS (SELECT *, w * h / (ta + da - w * h) AS iou FROM o WHERE w > 0 AND h > 0)
    SELECT video, frame, Track_ID, det_no, round(iou, 6) AS iou
    FROM (SELECT *, row_number() OVER (PARTITION BY video, frame, Track_ID ORDER BY iou DESC, det_no) AS i FROM r) WHERE i = 1
    """, "dets")
def _(s, d):
    return rounded(K.match_tracks(boxes(s, d), B.dets(s, d)).select("video", "frame", "Track_ID", "det_no", "iou"))


@query("keypoints_to_long", " UNION ALL ".join(f"""
    SELECT ordinal, '{k}' AS keypoint, round({k}_x, 6) AS x, round({k}_y, 6) AS y, {k}_conf AS conf FROM tracks""" for k in TORSO),
       "tracks")
def _(s, d):
    return rounded(K.keypoints_to_long(B.tracks(s, d).drop("conf"), TORSO).select("ordinal", "keypoint", "x", "y", "conf"))


@query("keypoints_to_wide", "SELECT ordinal, " + ", ".join(f"round({c}, 6) AS {c}" for c in POINTS) + " FROM tracks", "tracks")
def _(s, d):
    long = K.keypoints_to_long(B.tracks(s, d).drop("conf"), TORSO)
    return rounded(K.keypoints_to_wide(long, ["ordinal"], TORSO))


def centred(s, d):
    return K.track_centroid(B.tracks(s, d))


@query("track_centroid", """
    SELECT ordinal, round(centroid_x, 6) AS centroid_x, round(centroid_y, 6) AS centroid_y FROM centroids""", "centroids")
def _(s, d):
    return rounded(centred(s, d).select("ordinal", "centroid_x", "centroid_y"))


@query("remap_frames", """
    SELECT ordinal, f - CASE WHEN lo >= n_frames OR hi < 0 THEN lo ELSE 0 END AS Frame_ID
    FROM (SELECT *, min(f) OVER (PARTITION BY video) AS lo, max(f) OVER (PARTITION BY video) AS hi
          FROM (SELECT *, Frame_ID + CASE WHEN CAST(video AS BIGINT) % 2 = 0 THEN 5000 ELSE -100 END AS f,
                       max(Frame_ID) OVER (PARTITION BY video) + 1 AS n_frames FROM tracks))
    WHERE f - CASE WHEN lo >= n_frames OR hi < 0 THEN lo ELSE 0 END BETWEEN 0 AND n_frames - 1""", "tracks")
def _(s, d):
    shift = F.when(F.col("video").cast("bigint") % 2 == 0, 5000).otherwise(-100)
    moved = B.tracks(s, d).withColumn("Frame_ID", F.col("Frame_ID") + shift)
    return K.remap_frames(moved, videos(s, d)).select("ordinal", "Frame_ID")


H = ((1.5, 0.1, 3.0), (-0.2, 2.0, 1.0), (0.001, 0.002, 1.0))


@query("project_to_floor", """
    SELECT det_no, round((1.5 * x1 + 0.1 * y1 + 3) / (0.001 * x1 + 0.002 * y1 + 1), 6) AS floor_x,
           round((-0.2 * x1 + 2 * y1 + 1) / (0.001 * x1 + 0.002 * y1 + 1), 6) AS floor_y FROM dets""", "dets")
def _(s, d):
    return rounded(K.project_to_floor(B.dets(s, d), H, "x1", "y1").select("det_no", "floor_x", "floor_y"))


@query("as_of_pose", """
    , p AS (SELECT video, Track_ID, Frame_ID, max(ordinal) AS ordinal FROM tracks GROUP BY 1, 2, 3),
    n AS (SELECT *, least(Frame_ID + 30, max(Frame_ID) OVER (PARTITION BY video), coalesce(lead(Frame_ID) OVER (PARTITION BY video, Track_ID ORDER BY Frame_ID) - 1,
                          1000000)) AS until FROM p)
    SELECT video, Track_ID, unnest(generate_series(Frame_ID, until)) AS frame, Frame_ID AS pose_frame, ordinal FROM n""", "tracks")
def _(s, d):
    poses = B.tracks(s, d).select("video", "Track_ID", "Frame_ID", "ordinal")
    return K.as_of_pose(poses, videos(s, d), order="ordinal").select("video", "Track_ID", "frame", "pose_frame", "ordinal")


PROFILED = (
    ("x1", "double"), ("y1", "double"), ("x2", "double"), ("y2", "double"), ("conf", "double"), ("frame", "bigint"),
    ("det_no", "bigint"), ("cls", "int"))


@query("profile", " UNION ALL ".join(f"""
    SELECT '{c}' AS "column", '{t}' AS "type", count(*) AS rows, count({c}) AS count, round(avg({c}), 6) AS mean,
           round(stddev_samp({c}), 6) AS std, round(CAST(min({c}) AS DOUBLE), 6) AS min, round(CAST(max({c}) AS DOUBLE), 6) AS max,
           round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50,
           round(quantile_cont({c}, 0.75), 6) AS q75, count(*) - count({c}) AS missing,
           round((count(*) - count({c})) * 100.0 / count(*), 6) AS missing_pct
    FROM (SELECT * REPLACE (CASE WHEN k >= 10 THEN y1 END AS y1) FROM (SELECT *, CAST(y1 AS BIGINT) AS k FROM dets))"""
    for c, t in PROFILED), "dets")
def _(s, d):
    rows = B.dets(s, d).withColumn("y1", F.when(F.col("y1") >= 10, F.col("y1")))
    return rounded(K.profile(rows.select(*[c for c, _ in PROFILED])))


@query("missing_columns", " UNION ALL ".join(f"""
    SELECT '{c}' AS "column", count(*) - count({c}) AS missing,
           round((count(*) - count({c})) * 100.0 / count(*), 6) AS missing_pct FROM tracks HAVING count({c}) < count(*)"""
    for c in ("video", "Track_ID", "Frame_ID", "Timestamp", "ordinal", "conf", *POINTS)), "tracks")
def _(s, d):
    return rounded(K.missing_columns(B.tracks(s, d)))


@query("track_profile", """
    SELECT count(*) AS rows, min(Frame_ID) AS min_frame, max(Frame_ID) AS max_frame, count(DISTINCT Frame_ID) AS frames,
           round(min(Timestamp), 6) AS min_time, round(max(Timestamp), 6) AS max_time, count(DISTINCT Track_ID) AS tracks,
           round(count(*) / count(DISTINCT Frame_ID), 6) AS avg_detections FROM tracks""", "tracks")
def _(s, d):
    return rounded(K.track_profile(B.tracks(s, d)))


@query("track_shares", """
    SELECT Track_ID, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM tracks), 6) AS pct
    FROM tracks GROUP BY 1 ORDER BY n DESC, Track_ID LIMIT 10""", "tracks")
def _(s, d):
    return rounded(K.track_shares(B.tracks(s, d)))


@query("nose_rate", """
    SELECT count(*) AS rows, count(*) FILTER (Left_Hip_conf > 0) AS detected,
           round(count(*) FILTER (Left_Hip_conf > 0) * 100.0 / count(*), 6) AS pct FROM tracks""", "tracks")
def _(s, d):
    return rounded(K.nose_rate(B.tracks(s, d), "Left_Hip"))


PER_KEYPOINT = " UNION ALL ".join(f"""
    SELECT '{k}' AS keypoint, count(*) FILTER ({k}_conf > {{0}}) AS detected, count(*) AS rows,
           count(*) FILTER ({k}_conf > {{0}}) * 100.0 / count(*) AS pct,
           avg({k}_conf) FILTER ({k}_conf > {{0}}) AS mean_conf FROM tracks""" for k in TORSO)


@query("keypoint_stats", f"""
    SELECT keypoint, detected, rows, round(pct, 6) AS pct, round(mean_conf, 6) AS mean_conf FROM ({PER_KEYPOINT.format(0)})""", "tracks")
def _(s, d):
    return rounded(K.keypoint_stats(B.tracks(s, d), TORSO))


@query("region_rates", f"""
    SELECT CASE WHEN keypoint LIKE '%Hip' THEN 'lower' ELSE 'upper' END AS region, CAST(sum(detected) AS BIGINT) AS detected,
           CAST(sum(rows) AS BIGINT) AS possible, round(sum(detected) * 100.0 / sum(rows), 6) AS rate_pct,
           round(avg(mean_conf), 6) AS mean_conf FROM ({PER_KEYPOINT.format(0.3)}) GROUP BY 1""", "tracks")
def _(s, d):
    return rounded(K.region_rates(B.tracks(s, d), TORSO))


RATES = """
    round((count(*) FILTER (Left_Shoulder_conf > 0.3) + count(*) FILTER (Right_Shoulder_conf > 0.3)) * 100.0 / (2 * count(*)), 6) AS upper_rate,
    round((count(*) FILTER (Left_Hip_conf > 0.3) + count(*) FILTER (Right_Hip_conf > 0.3)) * 100.0 / (2 * count(*)), 6) AS lower_rate"""


@query("track_region_rates", f"SELECT video, Track_ID, count(*) AS frames, {RATES} FROM tracks GROUP BY 1, 2", "tracks")
def _(s, d):
    return rounded(K.track_region_rates(B.tracks(s, d), TORSO))


@query("diagnose", f"""
    SELECT *, CASE WHEN upper_rate < 50 AND lower_rate > 70 THEN 'warning' WHEN upper_rate < 30 THEN 'critical' ELSE 'ok' END AS verdict
    FROM (SELECT {RATES} FROM tracks)""", "tracks")
def _(s, d):
    return rounded(K.diagnose(B.tracks(s, d), TORSO))


LONG_ENOUGH = """
    SELECT * FROM (SELECT *, max(Timestamp) OVER w - min(Timestamp) OVER w AS dur FROM tracks
                   WINDOW w AS (PARTITION BY video, Track_ID)) WHERE dur >= 1.5"""


@query("drop_short_tracks", f"SELECT video, Track_ID, Frame_ID, ordinal FROM ({LONG_ENOUGH})", "tracks")
def _(s, d):
    return K.drop_short_tracks(B.tracks(s, d)).select("video", "Track_ID", "Frame_ID", "ordinal")


@query("track_endpoints", """
    SELECT video, Track_ID, arg_min(Frame_ID, (Frame_ID, ordinal)) AS start_frame, round(arg_min(Timestamp, (Frame_ID, ordinal)), 6) AS start_time,
           round(arg_min(x, (Frame_ID, ordinal)), 6) AS start_x, round(arg_min(y, (Frame_ID, ordinal)).v, 6) AS start_y,
           arg_max(Frame_ID, (Frame_ID, ordinal)) AS end_frame, round(arg_max(Timestamp, (Frame_ID, ordinal)), 6) AS end_time,
           round(arg_max(x, (Frame_ID, ordinal)), 6) AS end_x, round(arg_max(y, (Frame_ID, ordinal)).v, 6) AS end_y, count(*) AS n_rows
    FROM (SELECT *, centroid_x AS x, {'v': centroid_y} AS y FROM centroids) GROUP BY 1, 2""", "centroids")
def _(s, d):
    return rounded(K.track_endpoints(centred(s, d), "ordinal"))


# the greedy fold, one look ahead a step: `i` is the fragment whose chain grows, `k` the chain's last one, `owner` whose each is
MERGED = """
    , kept AS (""" + LONG_ENOUGH.replace("FROM tracks", "FROM centroids") + """),
    ends AS (SELECT *, row_number() OVER (PARTITION BY video ORDER BY a.Timestamp, Track_ID) AS i FROM (
                 SELECT video, Track_ID, arg_min(r, (r.Frame_ID, r.ordinal)) AS a, arg_max(r, (r.Frame_ID, r.ordinal)) AS b
                 FROM (SELECT video, Track_ID, {'Frame_ID': Frame_ID, 'ordinal': ordinal, 'Timestamp': Timestamp,
                                                'x': centroid_x, 'y': centroid_y} AS r FROM kept) GROUP BY 1, 2)),
    fits AS (SELECT p.video, p.i, list(q.i ORDER BY q.i) AS js FROM ends p JOIN ends q ON q.video = p.video AND q.i > p.i
             WHERE q.a.Timestamp - p.b.Timestamp >= -0.5 AND q.a.Timestamp - p.b.Timestamp <= 3.0
               AND CASE WHEN p.b.x IS NULL OR q.a.x IS NULL THEN 0 ELSE sqrt((p.b.x - q.a.x) ** 2 + (p.b.y - q.a.y) ** 2) END <= 300
             GROUP BY 1, 2),
    scenes AS (SELECT video, count(*) AS n, list(Track_ID ORDER BY i) AS ids, list(coalesce(js, []) ORDER BY i) AS js
               FROM ends LEFT JOIN fits USING (video, i) GROUP BY 1),
    fold AS (SELECT video, 1::BIGINT AS i, 1::BIGINT AS k, generate_series(1, n) AS owner FROM scenes
             UNION ALL
             SELECT video, CASE WHEN c IS NULL THEN i + 1 ELSE i END, coalesce(c, i + 1),
                    CASE WHEN c IS NULL THEN owner
                         ELSE list_transform(owner, lambda o: CASE WHEN o = owner[c] THEN owner[i] ELSE o END) END
             FROM (SELECT video, i, k, owner, list_filter(js[k], lambda j: owner[j] <> owner[i])[1] AS c
                   FROM fold JOIN scenes USING (video) WHERE i <= n)),
    chains AS (SELECT video, ids[p] AS Track_ID, ids[owner[p]] AS merged_id
               FROM (SELECT video, ids, owner, unnest(generate_series(1, n)) AS p FROM fold JOIN scenes USING (video) WHERE i = n + 1)),
    merged AS (SELECT kept.* REPLACE (merged_id AS Track_ID) FROM kept JOIN chains USING (video, Track_ID))"""


@query("merge_fragments", MERGED + "SELECT video, Track_ID, Frame_ID, ordinal FROM merged", "centroids")
def _(s, d):
    return K.merge_fragments(K.drop_short_tracks(centred(s, d)), ordinal="ordinal").select(
        "video", "Track_ID", "Frame_ID", "ordinal")


GRID = """
    , first_rows AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY video, Track_ID, Frame_ID ORDER BY ordinal) AS i FROM tracks)
                     WHERE i = 1),
    grid AS (SELECT video, Track_ID, unnest(generate_series(min(Frame_ID), max(Frame_ID))) AS Frame_ID FROM first_rows GROUP BY 1, 2),
    full_rows AS (SELECT g.video, g.Track_ID, g.Frame_ID, f.Timestamp, """ + ", ".join(f"f.{c}" for c in POINTS) + """
                  FROM grid g LEFT JOIN first_rows f USING (video, Track_ID, Frame_ID))"""
NINE = ", ".join(f"round({c}, 9) AS {c}" for c in ("Timestamp", *POINTS))


def grid(s, d):
    return K.reindex_frames(B.tracks(s, d), "ordinal", ["Timestamp", *POINTS])


@query("reindex_frames", GRID + """
    SELECT video, Track_ID, Frame_ID, """ + NINE + " FROM full_rows", "tracks")
def _(s, d):
    return rounded(grid(s, d), 9)


def _between(c: str, edge: bool) -> str:
    high = f"coalesce(lo_{c}.v, hi_{c}.v)" if edge else f"lo_{c}.v"
    return f"""CASE WHEN lo_{c}.v IS NOT NULL AND hi_{c}.v IS NOT NULL AND hi_{c}.f > lo_{c}.f
        THEN lo_{c}.v + (hi_{c}.v - lo_{c}.v) * (Frame_ID - lo_{c}.f) / (hi_{c}.f - lo_{c}.f) ELSE {high} END"""


FILLED = GRID + ", bounds AS (SELECT *, " + ", ".join(
    f"""last_value(CASE WHEN {c} IS NOT NULL THEN {{'f': Frame_ID, 'v': {c}}} END IGNORE NULLS)
            OVER (PARTITION BY video, Track_ID ORDER BY Frame_ID ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS lo_{c},
        first_value(CASE WHEN {c} IS NOT NULL THEN {{'f': Frame_ID, 'v': {c}}} END IGNORE NULLS)
            OVER (PARTITION BY video, Track_ID ORDER BY Frame_ID ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS hi_{c}"""
    for c in ("Timestamp", *POINTS)
) + f""" FROM full_rows),
    filled AS (SELECT video, Track_ID, Frame_ID, {_between('Timestamp', False)} AS Timestamp,
                      {', '.join(f'{_between(c, True)} AS {c}' for c in POINTS)} FROM bounds)"""


@query("interpolate_linear", FILLED + """
    SELECT video, Track_ID, Frame_ID, """ + NINE + " FROM filled", "tracks")
def _(s, d):
    return rounded(K.fill_gaps(B.tracks(s, d), "ordinal", POINTS), 9)


@query("smooth_centered", FILLED + """
    SELECT video, Track_ID, Frame_ID, """ + ", ".join(f"round(avg({c}) OVER w, 9) AS {c}" for c in COORDS) + """
    FROM filled WINDOW w AS (PARTITION BY video, Track_ID ORDER BY Frame_ID ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)""", "tracks")
def _(s, d):
    return rounded(K.fill_gaps_smoothed(B.tracks(s, d), "ordinal", COORDS, COORDS, time=None), 9)


@query("clean_tracks", MERGED + FILLED.replace("FROM tracks", "FROM merged") + """
    SELECT video, Track_ID, Frame_ID, round(Timestamp, 9) AS Timestamp, """ + ", ".join(
        f"round({f'avg({c}) OVER w' if c in COORDS else c}, 9) AS {c}" for c in POINTS) + """
    FROM filled WINDOW w AS (PARTITION BY video, Track_ID ORDER BY Frame_ID ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)""", "centroids")
def _(s, d):
    return rounded(K.clean_tracks(B.tracks(s, d), "ordinal", TORSO, ordered=False), 9)


@query("union_tracks", """
    SELECT video, Track_ID, Frame_ID, ordinal FROM tracks UNION ALL SELECT video, Track_ID + 1000, Frame_ID, NULL FROM tracks""", "tracks")
def _(s, d):
    t = B.tracks(s, d).select("video", "Track_ID", "Frame_ID", "ordinal")
    return K.union_tracks([t, t.drop("ordinal").withColumn("Track_ID", F.col("Track_ID") + 1000)])


@query("track_motion", """
    SELECT video, Track_ID, count(*) AS frame_count, round(max(Timestamp) - min(Timestamp), 6) AS duration_sec,
           round(avg(conf), 6) AS avg_confidence, round(avg(centroid_x), 6) AS mean_x, round(avg(centroid_y), 6) AS mean_y,
           round(coalesce(sum(sqrt((centroid_x - px) ** 2 + (centroid_y - py) ** 2)), 0), 6) AS movement_px
    FROM (SELECT *, lag(centroid_x) OVER w AS px, lag(centroid_y) OVER w AS py FROM centroids
          WINDOW w AS (PARTITION BY video, Track_ID ORDER BY Frame_ID, ordinal)) GROUP BY 1, 2""", "centroids")
def _(s, d):
    return rounded(K.track_motion(centred(s, d), "ordinal"))
