"""Queries over recording files."""

from pyspark.sql import functions as F

from reelspark.constants import CAMERAS
from reelspark.operators import assets as A
from reelspark.plans import bindings as B
from reelspark.plans.registry import query, rounded

CAMERA_LIST = ", ".join(f"'{c}'" for c in CAMERAS)
KEY = "recording_date, case_no, camera_name"


def keyed(s, d):
    return A.parse_recording_key(B.asset_files(s, d))


@query("parse_recording_key", f"SELECT path, {KEY} FROM keyed_files", "keyed_files")
def _(s, d):
    return keyed(s, d).select("path", "recording_date", "case_no", "camera_name")


@query("parse_recording_key_relative", f"SELECT {KEY}, length FROM keyed_files", "keyed_files")
def _(s, d):
    rooted = B.asset_files(s, d).withColumn("path", F.concat(F.lit("/archive/room/"), "path"))
    return A.parse_recording_key(rooted, mode="relative", root="/archive/room").select(
        "recording_date", "case_no", "camera_name", "length")


@query("parse_recording_key_anywhere", f"""
    SELECT CASE WHEN length > 500000000 THEN recording_date END AS recording_date,
           CASE WHEN length > 500000000 THEN case_no END AS case_no,
           CASE WHEN length > 500000000 THEN camera_name END AS camera_name, length FROM keyed_files""", "keyed_files")
def _(s, d):
    # half of the paths lose their camera level, which makes the whole key unknown
    short = F.regexp_extract("path", r"^(DATA_[^/]*/Case\d+)/", 1)
    deep = B.asset_files(s, d).withColumn("path", F.concat(
        F.lit("/mnt/a/b/"), F.when(F.col("length") > 500000000, F.col("path")).otherwise(short)))
    return A.parse_recording_key(deep, mode="anywhere").select("recording_date", "case_no", "camera_name", "length")


@query("exclude_junk", "SELECT path, length FROM asset_files WHERE path NOT LIKE '%/Monitor/%'", "asset_files")
def _(s, d):
    junk = B.asset_files(s, d).withColumn("_p", F.regexp_replace("path", "/Monitor/", "/Junk/"))
    return A.exclude_junk(junk, "_p").select("path", "length")


@query("size_status", """
    SELECT status, CASE status WHEN 1 THEN '>=200MB' WHEN 2 THEN '<200MB' ELSE 'Missing' END AS label, count(*) AS n
    FROM (SELECT CASE WHEN path LIKE '%.mp4' THEN 3 WHEN length >= 200 * 1048576 THEN 1 ELSE 2 END AS status
          FROM asset_files) GROUP BY 1, 2""", "asset_files")
def _(s, d):
    size = F.when(~F.col("path").endswith(".mp4"), F.col("length"))
    return B.asset_files(s, d).select(A.size_status(size).alias("status")).withColumn(
        "label", A.size_status_label("status")).groupBy("status", "label").agg(F.count(F.lit(1)).alias("n"))


@query("presence_status", f"""
    SELECT {KEY}, CASE WHEN size_mb IS NULL THEN 2 ELSE 1 END AS status FROM mp4_status""", "mp4_status")
def _(s, d):
    return B.mp4_status(s, d).select("recording_date", "case_no", "camera_name",
                                     A.presence_status("size_mb").alias("status"))


@query("in_cameras", f"""
    SELECT {KEY}, size_mb FROM mp4_status WHERE camera_name IN ('Monitor', 'Patient_Monitor')""", "mp4_status")
def _(s, d):
    return A.in_cameras(B.mp4_status(s, d), ["Monitor", "Patient_Monitor"]).select(
        "recording_date", "case_no", "camera_name", "size_mb")


@query("date_contains", f"SELECT {KEY} FROM status_a WHERE contains(recording_date, '-07-')", "status_a")
def _(s, d):
    return A.date_contains(B.status_a(s, d), "-07-").select("recording_date", "case_no", "camera_name")


@query("small_files", "SELECT path, length FROM asset_files WHERE length < 100 * 1048576", "asset_files")
def _(s, d):
    return A.small_files(B.asset_files(s, d), 100)


@query("freed_space", """
    SELECT count(*) AS files, round(coalesce(sum(length), 0) / 1048576.0, 6) AS freed_mb
    FROM asset_files WHERE length < 100 * 1048576""", "asset_files")
def _(s, d):
    return rounded(A.freed_space(B.asset_files(s, d), 100))


@query("tag_undersized", """
    SELECT path, camera_name || CASE WHEN length < 200 * 1048576 THEN '_JUNK' ELSE '' END AS channel
    FROM keyed_files""", "keyed_files")
def _(s, d):
    return keyed(s, d).select("path", A.tag_undersized("camera_name", "length").alias("channel"))


@query("map_channels", f"""
    SELECT path, CASE WHEN camera_name = 'General_3' THEN 'Unknown' ELSE camera_name END AS camera
    FROM keyed_files""", "keyed_files")
def _(s, d):
    spelled = F.when(F.col("camera_name") == "General_3", "Ceiling 3").otherwise(
        F.upper(F.translate("camera_name", "_", " ")))
    return keyed(s, d).select("path", A.map_channels(spelled).alias("camera"))


@query("select_camera", """
    SELECT recording_date, case_no, camera_name, path FROM mp4_status
    WHERE camera_name IN ('Monitor', 'Patient_Monitor')""", "mp4_status")
def _(s, d):
    return A.select_camera(B.mp4_status(s, d), ["Monitor", "Patient_Monitor"]).select(
        "recording_date", "case_no", "camera_name", "path")


LARGEST = f"""
    SELECT {KEY}, max(length) // 1048576 AS size_mb, 'root/' || arg_min(path, (-length, path)) AS path,
           CASE WHEN max(length) >= 200 * 1048576 THEN 1 ELSE 2 END AS status
    FROM keyed_files GROUP BY {KEY}"""


@query("largest_file", LARGEST, "keyed_files")
def _(s, d):
    return A.largest_file(keyed(s, d), "root/")


@query("expected_grid", f"""
    SELECT c.recording_date, c.case_no, cam.camera_name, size_mb, path, coalesce(status, 3) AS status
    FROM (SELECT DISTINCT recording_date, case_no FROM keyed_files) c
    CROSS JOIN (SELECT unnest([{CAMERA_LIST}]) AS camera_name) cam
    LEFT JOIN ({LARGEST}) l ON l.recording_date = c.recording_date AND l.case_no = c.case_no
         AND l.camera_name = cam.camera_name""", "keyed_files")
def _(s, d):
    return A.expected_grid(A.largest_file(keyed(s, d), "root/"))


SUMMARY = f"""
    SELECT cam.camera_name, st.status, CASE st.status WHEN 1 THEN 'Present' ELSE 'Missing' END AS status_label,
           count(m.camera_name) AS n
    FROM (SELECT unnest([{CAMERA_LIST}]) AS camera_name) cam
    CROSS JOIN (SELECT DISTINCT CASE WHEN size_mb IS NULL THEN 2 ELSE 1 END AS status FROM mp4_status) st
    LEFT JOIN mp4_status m ON m.camera_name = cam.camera_name
         AND CASE WHEN m.size_mb IS NULL THEN 2 ELSE 1 END = st.status
    GROUP BY 1, 2"""


@query("status_summary", SUMMARY, "mp4_status")
def _(s, d):
    return A.status_summary(B.mp4_status(s, d))


@query("status_pivot", """
    SELECT camera_name, count(size_mb) AS "Present", count(*) - count(size_mb) AS "Missing"
    FROM mp4_status GROUP BY 1""", "mp4_status")
def _(s, d):
    return A.status_pivot(B.mp4_status(s, d))


@query("status_totals", f"SELECT status_label, CAST(sum(n) AS BIGINT) AS n FROM ({SUMMARY}) GROUP BY 1", "mp4_status")
def _(s, d):
    return A.status_totals(B.mp4_status(s, d))


@query("case_total", """
    SELECT count(DISTINCT recording_date || '-' || case_no) AS cases FROM mp4_status""", "mp4_status")
def _(s, d):
    return A.case_total(B.mp4_status(s, d))


def _backup(s, d):
    files = B.asset_files(s, d)
    # the destination keeps another folder layout and lacks the smaller takes
    return files, files.filter("length > 300000000").withColumn("path", F.concat(F.lit("backup/"), "path"))


@query("backup_check", """
    SELECT path, length, split_part(path, '/', 4) AS name,
           (split_part(path, '/', 4), length) IN (SELECT (split_part(path, '/', 4), length) FROM asset_files
                                                  WHERE length > 300000000) AS backed_up
    FROM asset_files""", "asset_files")
def _(s, d):
    return A.backup_check(*_backup(s, d))


@query("backup_rate", """
    SELECT count(*) AS scanned, count(*) FILTER (b) AS found, count(*) FILTER (NOT b) AS missing,
           round(count(*) FILTER (b) * 100.0 / count(*), 6) AS rate
    FROM (SELECT (split_part(path, '/', 4), length) IN (SELECT (split_part(path, '/', 4), length) FROM asset_files
                                                        WHERE length > 300000000) AS b FROM asset_files)""", "asset_files")
def _(s, d):
    return rounded(A.backup_rate(*_backup(s, d)))


STEMS = r"""
    SELECT path, regexp_extract(path, '^(.*)/[^/]*$', 1) AS dir,
           regexp_replace(regexp_extract(path, '([^/]*)$', 1), '(\.seq\.idx|\.seq|\.xml|\.aud)$', '') AS stem,
           regexp_extract(path, '(\.seq\.idx|\.[^.]*)$', 1) AS ext FROM bundle_files"""


@query("orphan_companions", f"""
    SELECT path, dir, stem, ext FROM ({STEMS}) a
    WHERE ext <> '.seq' AND NOT EXISTS (SELECT 1 FROM ({STEMS}) b WHERE b.ext = '.seq' AND b.dir = a.dir AND b.stem = a.stem)
    """, "bundle_files")
def _(s, d):
    return A.orphan_companions(B.bundle_files(s, d))


@query("orphan_counts", f"""
    SELECT ext, count(*) AS n FROM ({STEMS}) a
    WHERE ext <> '.seq' AND NOT EXISTS (SELECT 1 FROM ({STEMS}) b WHERE b.ext = '.seq' AND b.dir = a.dir AND b.stem = a.stem)
    GROUP BY ext""", "bundle_files")
def _(s, d):
    return A.orphan_companions(B.bundle_files(s, d)).groupBy("ext").agg(F.count(F.lit(1)).alias("n"))


@query("attach_companions", f"""
    SELECT a.path AS seq_path, a.stem, max(b.path) FILTER (b.ext = '.seq.idx') AS idx,
           max(b.path) FILTER (b.ext = '.xml') AS xml, max(b.path) FILTER (b.ext = '.aud') AS aud,
           CAST(count(b.path) AS INT) AS n
    FROM ({STEMS}) a LEFT JOIN ({STEMS}) b ON b.dir = a.dir AND b.stem = a.stem AND b.ext <> '.seq'
    WHERE a.ext = '.seq' GROUP BY a.path, a.stem""", "bundle_files")
def _(s, d):
    return A.attach_companions(B.bundle_files(s, d)).select(
        "seq_path", "stem", F.col("companions")[".seq.idx"].alias("idx"), F.col("companions")[".xml"].alias("xml"),
        F.col("companions")[".aud"].alias("aud"), F.size("companions").alias("n"))


@query("rebase_paths", """
    SELECT k, CASE WHEN length > 700000000 THEN '/old/' || path WHEN length > 100000000 THEN 'new/' || path END AS resolved_path
    FROM (SELECT *, '/old/' || path AS k FROM asset_files)""", "asset_files")
def _(s, d):
    files = B.asset_files(s, d)
    stored = F.when(F.col("length") > 700000000, F.concat(F.lit("/old/"), "path")).when(
        F.col("length") > 100000000, F.concat(F.lit("new/"), "path"))
    inventory = files.select(stored.alias("path")).filter("path IS NOT NULL")
    rows = files.select(F.concat(F.lit("/old/"), "path").alias("path"))
    return A.rebase_paths(rows, inventory, "new").select(F.col("path").alias("k"), "resolved_path")


@query("reuse_cached", """
    SELECT b.case_no, b.size_mb, CASE WHEN ok THEN a.size_mb * 2.0 END::DOUBLE AS metric, NOT ok AS needs_compute
    FROM status_b b LEFT JOIN status_a a USING (recording_date, case_no, camera_name),
    LATERAL (SELECT a.size_mb IS NOT NULL AND b.size_mb IS NOT DISTINCT FROM a.size_mb AS ok)""", "status_a status_b")
def _(s, d):
    cached = B.status_a(s, d).withColumn("metric", F.col("size_mb") * 2.0)
    out = A.reuse_cached(B.status_b(s, d), cached, A.RECORDING_KEY, "size_mb", "metric")
    return out.select("case_no", "size_mb", "metric", "needs_compute")


@query("pick_group", """
    SELECT path, CASE WHEN camera_name IN ('Cart_Center_2', 'Cart_LT_4', 'Cart_RT_1', 'General_3') THEN 'A'
                      WHEN camera_name IN ('Monitor', 'Patient_Monitor', 'Ventilator_Monitor') THEN 'B'
                      ELSE 'solo_' || camera_name END AS sync_group FROM keyed_files""", "keyed_files")
def _(s, d):
    return keyed(s, d).select("path", A.pick_group("camera_name").alias("sync_group"))


@query("verify_copies", """
    SELECT path AS relative_path, length > 200000000 AS verified FROM (SELECT DISTINCT path, length FROM asset_files)
    """, "asset_files")
def _(s, d):
    # by path alone, which serves the join too: digests are made behind the shuffle, and never shuffled
    files = B.asset_files(s, d).repartition("path").distinct()
    text = F.concat("path", F.col("length").cast("string"))
    src = files.select(F.col("path").alias("relative_path"), F.sha2(text, 256).alias("sha256"))
    dst = files.filter("length > 200000000").select(
        F.col("path").alias("relative_path"), F.sha2(text, 256).alias("sha256"))
    return A.verify_copies(src, dst).select("relative_path", "verified")


@query("group_cases", """
    , moments AS (SELECT date, stamp, row_number() OVER (PARTITION BY date ORDER BY stamp) AS i,
                         epoch(strptime(stamp, '%Y-%m-%d_%H-%M-%S')) AS sec
                  FROM (SELECT DISTINCT date, stamp FROM stamped_files)),
    folded AS (SELECT date, stamp, i, sec, sec AS anchor, 1 AS case_no FROM moments WHERE i = 1
               UNION ALL
               SELECT m.date, m.stamp, m.i, m.sec, CASE WHEN m.sec - f.anchor > 1800 THEN m.sec ELSE f.anchor END,
                      f.case_no + CASE WHEN m.sec - f.anchor > 1800 THEN 1 ELSE 0 END
               FROM folded f JOIN moments m ON m.date = f.date AND m.i = f.i + 1)
    SELECT s.date, s.stamp, s.order_no, s.part_no, f.case_no FROM stamped_files s JOIN folded f USING (date, stamp)
    """, "stamped_files")
def _(s, d):
    return A.group_cases(B.stamped_files(s, d))


def _manifest(s, d):
    """Every take of a camera and day would be copied to one name; paths may repeat."""
    return keyed(s, d).select(
        F.col("path").alias("source_path"),
        F.concat_ws("/", F.col("recording_date"), F.concat("camera_name", F.lit(".mp4"))).alias("destination_path"),
    )


@query("unique_names", """
    SELECT source_path, destination_path,
           CASE WHEN i = 1 THEN destination_path
                ELSE left(destination_path, length(destination_path) - 4) || '_' || (i - 1) || '.mp4' END AS unique_path
    FROM (SELECT *, row_number() OVER (PARTITION BY destination_path ORDER BY md5(source_path), source_path) AS i
          FROM (SELECT DISTINCT path AS source_path, recording_date || '/' || camera_name || '.mp4' AS destination_path
                FROM keyed_files))""", "keyed_files")
def _(s, d):
    return A.unique_names(_manifest(s, d), distinct=True)


@query("distinct_channels", """
    SELECT DISTINCT camera_name AS channel FROM keyed_files WHERE path LIKE '%.seq'""", "keyed_files")
def _(s, d):
    return A.distinct_channels(B.asset_files(s, d))


@query("space_budget", """
    SELECT CAST(sum(length) AS BIGINT) AS total_bytes, sum(length) + 104857600 <= 40000000000000 AS fits
    FROM asset_files""", "asset_files")
def _(s, d):
    return A.space_budget(B.asset_files(s, d), 40000000000000, "length")


@query("copy_plan_totals", """
    SELECT recording_date AS date, case_no AS case_number, camera_name AS channel, count(*) AS files,
           count(*) FILTER (path LIKE '%.seq') AS sequences, CAST(sum(length) AS BIGINT) AS bytes
    FROM keyed_files GROUP BY ROLLUP (recording_date, case_no, camera_name)""", "keyed_files")
def _(s, d):
    manifest = keyed(s, d).select(
        F.regexp_extract("path", r"(\.seq\.idx|\.[^.]*)$", 1).alias("file_type"), F.col("length").alias("file_size"),
        F.struct(F.col("recording_date").alias("date"), F.col("camera_name").alias("channel"),
                 F.col("case_no").alias("case_number")).alias("sequence_info"))
    return A.copy_plan_totals(manifest)


@query("copy_plan", """
    , moments AS (SELECT date, stamp, row_number() OVER (PARTITION BY date ORDER BY stamp) AS i,
                         epoch(strptime(stamp, '%Y-%m-%d_%H-%M-%S')) AS sec
                  FROM (SELECT DISTINCT date, stamp FROM stamped_files)),
    folded AS (SELECT date, stamp, i, sec, sec AS anchor, 1 AS case_no FROM moments WHERE i = 1
               UNION ALL
               SELECT m.date, m.stamp, m.i, m.sec, CASE WHEN m.sec - f.anchor > 1800 THEN m.sec ELSE f.anchor END,
                      f.case_no + CASE WHEN m.sec - f.anchor > 1800 THEN 1 ELSE 0 END
               FROM folded f JOIN moments m ON m.date = f.date AND m.i = f.i + 1),
    takes AS (SELECT DISTINCT date, stamp, part_no FROM stamped_files)
    SELECT 'in/' || part_no || '/Monitor/' || stamp || '.seq' AS source_path,
           'out/DATA_' || date || '/Case' || f.case_no || '/' ||
           CASE WHEN part_no * 1000000 < 200 * 1048576 THEN 'Monitor_JUNK/' ELSE 'Monitor/' END || stamp || '.seq'
               AS destination_path,
           part_no * 1000000 AS file_size, '.seq' AS file_type, 'pending' AS status
    FROM takes JOIN folded f USING (date, stamp)""", "stamped_files")
def _(s, d):
    files = B.stamped_files(s, d).select(
        F.concat(F.lit("in/"), "part_no", F.lit("/Monitor/"), "stamp", F.lit(".seq")).alias("path"),
        (F.col("part_no") * 1000000).alias("length")).distinct()
    return A.copy_plan(files, "out").drop("sequence_info")
