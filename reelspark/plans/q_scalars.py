"""Queries of the scalar functions."""

from pyspark.sql import functions as F

from reelspark import functions as S
from reelspark.plans import bindings as B
from reelspark.plans.q_assets import keyed
from reelspark.plans.registry import query, rounded


@query("pivot_year", r"""
    SELECT CASE WHEN CAST(yy AS INT) <= 69 THEN '20' || yy ELSE '19' || yy END AS year, count(*) AS n
    FROM (SELECT regexp_extract(path, '^DATA_(\d\d)', 1) AS yy FROM asset_files) GROUP BY 1""", "asset_files")
def _(s, d):
    yy = F.regexp_extract("path", r"^DATA_(\d\d)", 1)
    return B.asset_files(s, d).groupBy(S.pivot_year(yy).alias("year")).agg(F.count(F.lit(1)).alias("n"))


def named(s, d):
    """File names in both date forms, and names without a date."""
    li = B.table(s, d, "lineitem")
    clock = F.format_string("%02d-%02d-%02d", (F.col("l_orderkey") % 24).cast("int"), (F.col("l_partkey") % 60).cast("int"),
                            (F.col("l_suppkey") % 60).cast("int"))
    return li.select(
        "l_orderkey", "l_partkey", "l_linenumber",
        F.when(F.col("l_returnflag") == "A", F.concat(F.date_format("l_shipdate", "yyyy-MM-dd"), F.lit("_"), clock, F.lit(".seq")))
        .when(F.col("l_returnflag") == "R", F.concat(F.date_format("l_shipdate", "MM-dd-yy"), F.lit("_"), clock, F.lit(".123.seq")))
        .otherwise(F.concat(F.lit("video_"), "l_orderkey", F.lit(".seq"))).alias("name"))


NAMED = """
    WITH named AS (SELECT l_orderkey, l_partkey, l_linenumber, l_shipdate, l_returnflag, l_suppkey,
                          printf('%02d-%02d-%02d', l_orderkey % 24, l_partkey % 60, l_suppkey % 60) AS clock FROM lineitem)"""


@query("date_from_filename", NAMED + """
    SELECT l_orderkey, l_partkey, CASE WHEN l_returnflag <> 'N' THEN strftime(l_shipdate, '%y-%m-%d') END AS day FROM named""")
def _(s, d):
    return named(s, d).select("l_orderkey", "l_partkey", S.date_from_filename("name").alias("day"))


@query("timestamp_from_stem", NAMED + """
    SELECT l_orderkey, l_partkey, CASE WHEN l_returnflag <> 'N' THEN strftime(l_shipdate, '%Y-%m-%d') || ' ' || replace(clock, '-', ':')
           END AS at FROM named""")
def _(s, d):
    stem = F.regexp_replace("name", r"\.seq$", "")
    return named(s, d).select("l_orderkey", "l_partkey", F.date_format(
        S.timestamp_from_stem(stem), "yyyy-MM-dd HH:mm:ss").alias("at"))


@query("date_from_mtime", "SELECT event_id, strftime(ts, '%y-%m-%d') AS day FROM events")
def _(s, d):
    return B.table(s, d, "events").select("event_id", S.date_from_mtime(F.col("ts").cast("timestamp")).alias("day"))


@query("hms_to_seconds", """
    SELECT video, CAST(s1 AS DOUBLE) AS a, CASE WHEN end_2 <> 'end' THEN CAST(end_2 AS DOUBLE) END AS b, s1 % 60 * 60 + 5.5::DOUBLE AS c
    FROM intervals""", "intervals")
def _(s, d):
    minutes = F.concat((S.hms_to_seconds("start_1") % 60).cast("int").cast("string"), F.lit(":05.5"))
    return B.intervals(s, d).select(
        "video", S.hms_to_seconds("start_1").alias("a"), S.hms_to_seconds("end_2").alias("b"),
        S.hms_to_seconds(minutes).alias("c"))


@query("jump_code_to_seconds", """
    SELECT event_id, CAST(CASE event_type WHEN 'click' THEN user_id * 60 + 7
        WHEN 'view' THEN value
        WHEN 'error' THEN NULL
        ELSE CASE WHEN event_id < 100 THEN event_id WHEN event_id < 10000 THEN event_id // 100 * 60 + event_id % 100
                  ELSE event_id // 10000 * 3600 + event_id % 10000 // 100 * 60 + event_id % 100 END END AS DOUBLE) AS seconds
    FROM events""")
def _(s, d):
    code = (
        F.when(F.col("event_type") == "click", F.concat(F.col("user_id"), F.lit(" 7")))
        .when(F.col("event_type") == "view", F.col("value").cast("string"))
        .when(F.col("event_type") == "error", F.lit("12x")).otherwise(F.col("event_id").cast("string")))
    return B.table(s, d, "events").select("event_id", S.jump_code_to_seconds(code).alias("seconds"))


@query("seconds_to_hms", """
    SELECT o_orderkey, printf('%02d:%02d:%02d', v // 3600, v % 3600 // 60, v % 60) AS whole,
           printf('%02d:%02d:%02d.250', v // 3600, v % 3600 // 60, v % 60) AS with_millis
    FROM (SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) AS v FROM orders)""")
def _(s, d):
    v = F.floor("o_totalprice")
    return B.table(s, d, "orders").select(
        "o_orderkey", S.seconds_to_hms(v + 0.9).alias("whole"), S.seconds_to_hms(v + 0.25, millis=True).alias("with_millis"))


@query("unix_to_text", """
    SELECT file, rec_no, CASE WHEN rec_no <> 0 THEN strftime(make_timestamp(ts_seconds * 1000000 + (ts_sub & 65535) * 1000 + (ts_sub >> 16)),
           '%Y-%m-%d %H:%M:%S.%f') END AS at FROM frames""", "frames")
def _(s, d):
    t = S.decode_frame_time("ts_seconds", "ts_sub")
    return B.frames(s, d).select("file", "rec_no", S.unix_to_text(F.when(F.col("rec_no") == 0, 0.0).otherwise(t)).alias("at"))


@query("person_code", """
    SELECT anesthesiology_key, upper(left(name, 1)) || upper(left(split_part(name, ' ', -1), 1)) ||
           substr(anesthesiology_start_date, 3, 2) || substr(anesthesiology_start_date, 6, 2) AS code FROM people""", "people")
def _(s, d):
    return B.people(s, d).select("anesthesiology_key", S.person_code("name", "anesthesiology_start_date").alias("code"))


@query("normalise_channel", """
    SELECT camera_name, lower(replace(replace(camera_name, '_', ''), ' ', '')) AS channel, count(*) AS n
    FROM keyed_files GROUP BY 1, 2""", "keyed_files")
def _(s, d):
    return keyed(s, d).groupBy("camera_name", S.normalise_channel("camera_name").alias("channel")).agg(
        F.count(F.lit(1)).alias("n"))


@query("case_from_filename", """
    SELECT l_orderkey, l_linenumber, l_suppkey, CASE WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'x' || l_suppkey
               ELSE CAST(l_suppkey AS VARCHAR) END AS case_text FROM lineitem""")
def _(s, d):
    li = B.table(s, d, "lineitem")
    supp = F.col("l_suppkey").cast("string")
    name = (
        F.when(F.col("l_returnflag") == "A", F.concat(supp, F.lit("_v01_000123.jpg")))
        .when(F.col("l_returnflag") == "R", F.concat(F.lit("case"), supp, F.lit("_v01_000123.jpg")))
        .when(F.col("l_linestatus") == "O", F.concat(supp, F.lit("_000123.jpg")))
        .otherwise(F.concat(F.lit("x"), supp, F.lit("_7.jpg"))))
    return li.select("l_orderkey", "l_linenumber", "l_suppkey", S.case_from_filename(name).alias("case_text"))


@query("parse_crop_name", """
    SELECT c.name, case_no, video_idx, frame_id FROM crops c LEFT JOIN parsed_crops USING (name)""", "crops parsed_crops")
def _(s, d):
    return B.crops(s, d).withColumn("_k", S.parse_crop_name("name")).select("name", "_k.*")


@query("bytes_to_mib", """
    SELECT path, length // 1048576 AS whole, round(length / 1048576.0, 6) AS exact FROM asset_files""", "asset_files")
def _(s, d):
    return rounded(B.asset_files(s, d).select("path", S.bytes_to_mib("length").alias("whole"),
                                              S.bytes_to_mib("length", whole=False).alias("exact")))


@query("relative_path", """
    SELECT path, path AS below_recordings, split_part(path, '/', 4) AS name_only, path AS below_data,
           split_part(path, '/', 2) || '/' || split_part(path, '/', 3) || '/' || split_part(path, '/', 4) AS last_three
    FROM asset_files""", "asset_files")
def _(s, d):
    stored = F.concat(F.lit("F:\\room\\RECORDINGS\\"), "path")
    return B.asset_files(s, d).select(
        "path", S.relative_path(stored).alias("below_recordings"), S.relative_path("path").alias("name_only"),
        S.relative_path(stored, "data").alias("below_data"), S.relative_path(stored, "last3").alias("last_three"))


@query("folder_from_key", """
    SELECT DISTINCT regexp_extract(path, '^(.*)/[^/]*$', 1) AS folder FROM asset_files""", "asset_files")
def _(s, d):
    return keyed(s, d).select(S.folder_from_key("recording_date", "case_no", "camera_name").alias("folder")).distinct()


@query("count_label", """
    SELECT recording_date, case_no, cameras_count || ' cam' AS cams,
           cameras_count || CASE WHEN cameras_count = 1 THEN ' case' ELSE ' cases' END AS cases FROM case_stats""", "case_stats")
def _(s, d):
    from reelspark.operators.dashboard import recording_statistics

    return recording_statistics(B.mp4_status(s, d)).select(
        "recording_date", "case_no", S.count_label("cameras_count", "cam", plural=False).alias("cams"),
        S.count_label("cameras_count", "case").alias("cases"))


@query("iou", """
    SELECT det_no, round(CASE WHEN w > 0 AND h > 0 THEN w * h / (2 * a - w * h) ELSE 0 END, 6) AS iou
    FROM (SELECT det_no, x2 - x1 - k AS w, 20.0::DOUBLE AS h, (x2 - x1) * 40 AS a
          FROM (SELECT *, CAST(y1 AS BIGINT) AS k FROM dets))""", "dets")
def _(s, d):
    moved = B.dets(s, d).withColumns({
        "m1": F.col("x1") + F.col("y1"), "n1": F.col("y1") + 20, "m2": F.col("x2") + F.col("y1"), "n2": F.col("y2") + 20})
    return rounded(moved.select("det_no", S.iou(("x1", "y1", "x2", "y2"), ("m1", "n1", "m2", "n2")).alias("iou")))


@query("euclidean", """
    SELECT det_no, round(sqrt((x2 - x1) ** 2 + (CASE WHEN conf > 0.1 THEN y2 END - y1) ** 2), 6) AS dist FROM dets""", "dets")
def _(s, d):
    y2 = F.when(F.col("conf") > 0.1, F.col("y2"))
    return rounded(B.dets(s, d).select("det_no", S.euclidean("x1", "y1", "x2", y2).alias("dist")))


@query("l2_normalise", """
    SELECT image, round(u[1], 6) AS first, round(u[64], 6) AS last, round(list_inner_product(u, u), 6) AS norm FROM reid""", "reid")
def _(s, d):
    unit = B.reid(s, d).withColumn("u", S.l2_normalise("vec"))
    return rounded(unit.select("image", F.element_at("u", 1).alias("first"), F.element_at("u", 64).alias("last"),
                               S.dot("u", "u").alias("norm")))


@query("cosine", """
    SELECT a.image, round(list_inner_product(a.u, b.u), 6) AS sim FROM reid a JOIN reid b ON b.image = a.image + 1""", "reid")
def _(s, d):
    r = B.reid(s, d)
    after = r.select((F.col("image") - 1).alias("image"), F.col("vec").alias("next_vec"))
    return rounded(r.join(after, "image").select("image", S.cosine("vec", "next_vec").alias("sim")))


@query("sync_status", """
    SELECT event_id, round(v, 6) AS delta, CASE WHEN abs(v) <= 0.3 THEN 'synced' ELSE 'out_of_sync' END AS status,
           CASE WHEN abs(v) <= 0.3 THEN '[OK] Synced' WHEN v > 0 THEN printf('+%.1fs ahead', v) ELSE printf('%.1fs behind', v) END AS text
    FROM (SELECT event_id, round(position, 1) - 10 + (event_id % 7) / 10.0 AS v FROM sessions)""", "sessions")
def _(s, d):
    status = S.sync_status(F.round("position", 1), F.lit(10.0), (F.col("event_id") % 7) / 10.0)
    return rounded(B.sessions(s, d).select("event_id", status.alias("_s")).select("event_id", "_s.*"))


@query("nudge", """
    SELECT event_id, round_even(offset_seconds + 0.1, 1) AS up, round_even(offset_seconds - 0.1, 1) AS down FROM sessions""", "sessions")
def _(s, d):
    return B.sessions(s, d).select("event_id", (S.nudge("offset_seconds", 0.1) + 0.0).alias("up"),
                                   (S.nudge("offset_seconds", -0.1) + 0.0).alias("down"))


@query("adjustment_text", """
    SELECT event_id, camera_name || ': ' || printf('%+.1f', offset_seconds + 0.2) || 's (was ' || printf('%+.1f', offset_seconds) || 's)'
           AS text FROM sessions""", "sessions")
def _(s, d):
    return B.sessions(s, d).select("event_id", S.adjustment_text(
        "camera_name", "offset_seconds", F.col("offset_seconds") + 0.2).alias("text"))


@query("bitrate", """
    SELECT path, CASE WHEN length > 900000000 THEN 2500000 WHEN length < 10000000 THEN 500000
                      ELSE length * 8 // 1000 END AS rate FROM asset_files""", "asset_files")
def _(s, d):
    given = F.when(F.col("length") > 900000000, 2500000)
    duration = F.when(F.col("length") < 10000000, 0).otherwise(1000)
    return B.asset_files(s, d).select("path", S.bitrate(given, "length", duration).alias("rate"))


@query("parse_probe_json", """
    SELECT event_id, round(CASE WHEN event_type <> 'error' THEN value / 60 END, 6) AS minutes FROM events""")
def _(s, d):
    return rounded(B.logs(s, d).select("event_id", S.parse_probe_json("report").alias("minutes")))


@query("parse_progress_line", """
    SELECT event_id, event_id AS frame, value AS fps, 1.5::DOUBLE AS speed, round(least(100, event_id / 5000 * 100), 6) AS percent
    FROM events""")
def _(s, d):
    parsed = B.logs(s, d).select("event_id", S.parse_progress_line("line", 5000).alias("_p"))
    return rounded(parsed.select("event_id", "_p.*"))


@query("log_line", """
    SELECT event_id, '[' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '] ' ||
           CASE WHEN event_type = 'view' THEN 'SKIPPED' WHEN event_type = 'error' THEN 'FAILED ' ELSE 'OK     ' END ||
           ' | ' || strftime(ts, '%Y-%m-%d') || ' Case' || user_id || ' Group A | ' || rpad(event_type, 25, ' ') || ' | ' ||
           CASE WHEN event_id = 0 THEN '--:--:--' ELSE printf('%02d:%02d:%02d', event_id // 3600, event_id % 3600 // 60, event_id % 60) END
           || ' | done' || CASE WHEN event_type = 'click' THEN ' | out/' || event_id ELSE '' END AS line
    FROM events""")
def _(s, d):
    e = B.table(s, d, "events")
    kind = F.col("event_type")
    return e.select("event_id", S.log_line(
        F.col("ts").cast("timestamp"), kind != "error", kind == "view", F.date_format("ts", "yyyy-MM-dd"), "user_id", F.lit("A"),
        kind, F.col("event_id").cast("double"), F.lit("done"),
        F.when(kind == "click", F.concat(F.lit("out/"), "event_id"))).alias("line"))


@query("seek_target", "SELECT event_id, round(greatest(0, position - 20 + offset_seconds), 6) AS target FROM sessions", "sessions")
def _(s, d):
    return rounded(B.sessions(s, d).select("event_id", S.seek_target(F.col("position") - 20, "offset_seconds").alias("target")))


@query("month_and_year", """
    SELECT recording_date, left(recording_date, 7) AS month, CAST(left(recording_date, 4) AS INT) AS year, count(*) AS n
    FROM mp4_status GROUP BY 1""", "mp4_status")
def _(s, d):
    return B.mp4_status(s, d).groupBy(
        "recording_date", S.month_of("recording_date").alias("month"), S.year_of("recording_date").alias("year")
    ).agg(F.count(F.lit(1)).alias("n"))
