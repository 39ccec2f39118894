"""Fixture views: the driver's tables seen as recording assets, frames, tracks, ….

Each view is a projection (at most one aggregation) written once for Spark and once, in `SQL`, for the oracle, and keeps
every row of its source table. Of the two sides of comparisons (`seq_status` and `mp4_status`, `status_a` and `status_b`) each
gives keys of its own to a part of the rows, and `labelled` to the cases without a label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from reelspark.constants import CAMERAS

#: Added to the case numbers of one side of a comparison; above all order keys of the tables.
OWN = 10**12
ORIGIN = 1704067200  # 2024-01-01, the first day of the events table


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _camera(key: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, CAMERAS)), (key % len(CAMERAS) + 1).cast("int"))


def _camera_sql(key: str) -> str:
    names = ", ".join(f"'{c}'" for c in CAMERAS)
    return f"([{names}])[CAST({key} % {len(CAMERAS)} AS INT) + 1]"


def _stamp(ts: str) -> Column:
    return F.col(ts).cast("timestamp")


def _two(n: Column) -> Column:
    """As `%02d`, at a fraction of its time: a format is read anew for each row."""
    text = n.cast("string")
    return F.when(n.between(0, 9), F.concat(F.lit("0"), text)).otherwise(text)


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("bigint")


_K = "CAST(json_extract(props, '$.k') AS BIGINT)"


def asset_files(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    ext = F.when(F.col("l_returnflag") == "A", ".seq").when(F.col("l_returnflag") == "R", ".mp4").otherwise(".seq.idx")
    return li.select(
        F.concat(
            F.lit("DATA_"), F.date_format("l_shipdate", "yy-MM-dd"), F.lit("/Case"), F.col("l_linenumber"), F.lit("/"),
            _camera(F.col("l_suppkey")), F.lit("/"), F.col("l_orderkey"), F.lit("_"), F.col("l_partkey"), ext,
        ).alias("path"),
        F.round(F.col("l_extendedprice") * 10000).cast("bigint").alias("length"),
    )


def stamped_files(spark: SparkSession, d: str) -> DataFrame:
    """Capture files named by their time; the same second of a day occurs often."""
    li = table(spark, d, "lineitem")
    minute = (F.col("l_partkey") * 7 + F.col("l_suppkey")) % 1440
    clock = F.concat_ws("-", _two(F.floor(minute / 60)), _two(minute % 60), _two(F.col("l_orderkey") % 60))
    return li.select(
        F.date_format("l_shipdate", "yy-MM-dd").alias("date"),
        F.concat(F.date_format("l_shipdate", "yyyy-MM-dd"), F.lit("_"), clock).alias("stamp"),
        F.col("l_orderkey").alias("order_no"), F.col("l_partkey").alias("part_no"),
    )


def bundle_files(spark: SparkSession, d: str) -> DataFrame:
    """Containers and companions of one directory per supplier, stems by order."""
    li = table(spark, d, "lineitem")
    ext = (
        F.when(F.col("l_returnflag") == "A", ".seq").when(F.col("l_returnflag") == "R", ".seq.idx")
        .when(F.col("l_linestatus") == "O", ".xml").otherwise(".aud")
    )
    return li.select(F.concat(F.lit("raw/"), F.col("l_suppkey"), F.lit("/"), F.col("l_orderkey"), ext).alias("path")).distinct()


def _status(spark: SparkSession, d: str, flag: str) -> DataFrame:
    """Rows of the other status and of line numbers above 3 are other cases here, so that each side has keys of its own."""
    li = table(spark, d, "lineitem")
    own = F.when((F.col("l_linestatus") != flag) & (F.col("l_linenumber") > 3), 10 if flag == "O" else 20).otherwise(0)
    keys = {
        "recording_date": F.date_format("l_shipdate", "yyyy-MM-dd"), "case_no": F.col("l_linenumber") + own,
        "camera_name": _camera(F.col("l_suppkey")),
    }
    return li.groupBy(*[c.alias(n) for n, c in keys.items()]).agg(
        F.when(F.max("l_discount") > 0.01, F.floor(F.max("l_extendedprice") / 100).cast("bigint")).alias("size_mb"),
        F.max("l_quantity").alias("duration_minutes"),
        F.min("l_partkey").alias("part_no"),
        F.round(F.max("l_tax") * 100 - 4, 1).alias("offset_seconds"),
    ).withColumn("path", F.concat(
        F.lit("DATA_"), F.substring("recording_date", 3, 8), F.lit("/Case"), "case_no", F.lit("/"), "camera_name",
        F.lit("/"), "part_no", F.lit(".mp4"),
    ))


def seq_status(spark: SparkSession, d: str) -> DataFrame:
    return _status(spark, d, "O")


def mp4_status(spark: SparkSession, d: str) -> DataFrame:
    return _status(spark, d, "F")


def details(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    return li.groupBy(
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("recording_date"), F.col("l_linenumber").alias("case_no")
    ).agg(F.max("l_partkey").alias("anesthesiology_key"))


def people(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part")
    start = F.date_add(F.lit("1990-01-01").cast("date"), (F.col("p_partkey") % 4000).cast("int"))
    return part.select(
        F.col("p_partkey").alias("anesthesiology_key"), F.col("p_name").alias("name"),
        start.cast("string").alias("anesthesiology_start_date"),
        F.when(F.col("p_size") <= 25, F.date_add(start, 1800).cast("string")).alias("grade_a_date"),
    )


def labelled(spark: SparkSession, d: str) -> DataFrame:
    """Labelled cases: those whose person has a label; the others are labelled under a number no recording has."""
    docs = table(spark, d, "labels").select(F.col("doc_id").alias("anesthesiology_key"), F.lit(0).alias("shift"))
    case = F.col("case_no") + F.coalesce("shift", F.lit(100))
    return details(spark, d).join(docs, "anesthesiology_key", "left").select("recording_date", case.alias("case_no"))


def _orders_status(spark: SparkSession, d: str, own: str, bump: str | None) -> DataFrame:
    """Orders of the priority `own` have case numbers that the other side lacks."""
    o = table(spark, d, "orders")
    size = F.floor(F.col("o_totalprice") / 1000).cast("bigint")
    if bump:
        size = size + F.when(F.col("o_orderstatus") == bump, 1).otherwise(0)
    return o.select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("recording_date"),
        (F.col("o_orderkey") + F.when(F.col("o_orderpriority") == own, OWN).otherwise(0)).alias("case_no"),
        _camera(F.col("o_custkey")).alias("camera_name"),
        F.when(F.col("o_orderpriority") != "5-LOW", size).alias("size_mb"),
        F.concat(F.lit("Recordings/"), F.col("o_custkey"), F.lit("/"), F.col("o_orderkey"), F.lit(".mp4")).alias("path"),
    )


def status_a(spark: SparkSession, d: str) -> DataFrame:
    return _orders_status(spark, d, "1-URGENT", None)


def status_b(spark: SparkSession, d: str) -> DataFrame:
    return _orders_status(spark, d, "2-HIGH", "F")


def frames(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    micros = F.unix_micros(_stamp("ts"))
    sub = micros % 1000000
    return e.select(
        F.col("user_id").cast("string").alias("file"), F.col("event_id").alias("rec_no"),
        (F.lit(1024) + F.col("event_id") * 1000).cast("bigint").alias("offset"),
        F.when(F.col("event_type") == "error", 8).otherwise(992).cast("bigint").alias("size"),
        F.floor(micros / 1000000).cast("bigint").alias("ts_seconds"),
        (F.shiftleft((sub % 1000).cast("bigint"), 16) + F.floor(sub / 1000).cast("bigint")).alias("ts_sub"),
        F.lit(0).cast("bigint").alias("flags"),
        (F.floor(F.col("event_id") / 100) % 97).cast("bigint").alias("frame_number"),
    )


def frame_rates(spark: SparkSession, d: str) -> DataFrame:
    """Nominal rate per file, 0 for some; file sizes and frame counts as a header would give them."""
    e = table(spark, d, "events")
    return e.groupBy(F.col("user_id").cast("string").alias("file")).agg(
        F.when(F.count_if(F.col("event_type") == "error") > 10, 0.00005).otherwise(0.0).alias("fps"),
        (F.max("event_id") * 1000 + 1500).cast("bigint").alias("file_size"),
        F.count_if(F.col("event_type") != "signup").alias("allocated_frames"),
    )


def tracks(spark: SparkSession, d: str) -> DataFrame:
    """Keypoint rows: video = user, one track per event type and week, one frame per hour."""
    e = table(spark, d, "events")
    hour = F.floor((F.unix_seconds(_stamp("ts")) - ORIGIN) / 3600).cast("bigint")
    kind = (
        F.when(F.col("event_type") == "click", 1).when(F.col("event_type") == "error", 2)
        .when(F.col("event_type") == "purchase", 3).when(F.col("event_type") == "signup", 4).otherwise(5)
    )
    base = e.select(
        F.col("user_id").cast("string").alias("video"), (kind * 10 + F.floor(hour / 168)).cast("bigint").alias("Track_ID"),
        hour.alias("Frame_ID"), (hour / 30.0).alias("Timestamp"), F.col("event_id").alias("ordinal"),
        F.col("value").alias("x"), F.when(_k() >= 10, _k().cast("double")).alias("y"), _k().alias("k"),
        ((F.col("event_id") % 100) / 100.0).alias("conf"),
    )
    shift = F.col("k") / 10.0
    return base.select(
        "video", "Track_ID", "Frame_ID", "Timestamp", "ordinal", "conf",
        *[c for name, sx, sy in (("Left_Shoulder", -1, -1), ("Right_Shoulder", 1, -1), ("Left_Hip", -1, 1),
                                 ("Right_Hip", 1, 1))
          for c in ((F.col("x") + sx * shift).alias(f"{name}_x"), (F.col("y") + sy * shift).alias(f"{name}_y"),
                    F.when(F.col("k") > (50 if sy < 0 else 25), F.col("conf")).otherwise(0.0).alias(f"{name}_conf"))],
    )


def dets(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    hour = F.floor((F.unix_seconds(_stamp("ts")) - ORIGIN) / 3600).cast("bigint")
    k = _k()
    return e.select(
        F.col("user_id").cast("string").alias("video"), hour.alias("frame"), F.col("event_id").alias("det_no"),
        F.col("value").alias("x1"), k.cast("double").alias("y1"), (F.col("value") + 20 + k / 2.0).alias("x2"),
        (k + 40).cast("double").alias("y2"), ((F.col("event_id") % 100) / 100.0).alias("conf"),
        F.when(k > 80, 1).otherwise(0).alias("cls"), F.col("event_type"),
    )


def sessions(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    k = _k()
    return e.select(
        F.date_format(_stamp("ts"), "yyyy-MM-dd").alias("recording_date"), F.col("user_id").cast("int").alias("case_no"),
        F.col("event_type").alias("camera_name"), _stamp("ts").alias("ts"),
        F.date_format(_stamp("ts"), "yyyy-MM-dd HH").alias("tick"), F.col("value").alias("position"),
        (F.when(k >= 95, 400.0).otherwise(0.0) + (k - 50) / 10.0).alias("offset_seconds"),
        (F.col("event_type") == "click").alias("is_reference"), F.col("event_id"),
    )


def crops(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    ext = F.when(F.col("l_discount") > 0.09, ".JPG").otherwise(".jpg")
    return li.select(F.concat(
        F.col("l_suppkey"), F.lit("_v"), _two(F.col("l_linenumber")), F.lit("_"), F.col("l_orderkey"), ext
    ).alias("name")).distinct()


def reid(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").select(
        F.col("label").alias("identity"), F.col("vec_id").alias("image"), F.col("embedding").alias("vec")
    )


def logs(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    return e.select(
        "event_id",
        F.concat(F.lit("frame=  "), "event_id", F.lit(" fps= "), F.col("value").cast("string"),
                 F.lit(" q=28.0 size=N/A speed=1.5x")).alias("line"),
        F.when(F.col("event_type") == "error", F.lit('{"format": {}}')).otherwise(
            F.concat(F.lit('{"format": {"duration": "'), F.col("value").cast("string"), F.lit('"}}'))).alias("report"),
    )


def intervals(spark: SparkSession, d: str) -> DataFrame:
    """One video per order with up to three case intervals in every accepted text form."""
    o = table(spark, d, "orders")
    length = F.floor(F.col("o_totalprice") / 1000).cast("bigint")
    s1 = F.col("o_custkey") % 5000
    e1 = s1 + length
    s2 = e1 + F.col("o_custkey") % 700 - 200
    e2 = s2 + length
    s3 = e2 + F.col("o_custkey") % 300
    clock = F.format_string("%d:%02d:%02d", F.floor(s1 / 3600), F.floor(s1 % 3600 / 60), s1 % 60)
    return o.select(
        F.col("o_orderkey").alias("video"),
        (F.lit(1500.0) + F.col("o_custkey") % 3000 + F.when(F.col("o_orderstatus") == "F", 4000.0).otherwise(0.0)).alias("duration_s"),
        clock.alias("start_1"), e1.cast("string").alias("end_1"),
        F.when(F.col("o_orderpriority") != "5-LOW", s2.cast("string")).alias("start_2"),
        F.when(F.col("o_orderpriority") == "2-HIGH", "end").otherwise(e2.cast("string")).alias("end_2"),
        F.when(F.col("o_orderstatus") != "P", s3.cast("string")).alias("start_3"),
        F.when(F.col("o_orderstatus") != "P", (s3 + 2 * length).cast("string")).alias("end_3"),
        F.concat(F.lit("v/"), F.col("o_orderkey"), F.lit(".mp4")).alias("path"),
    )


VIEWS_SQL: dict[str, tuple[tuple[str, ...], str]] = {
    "asset_files": ((), f"""
        SELECT 'DATA_' || strftime(l_shipdate, '%y-%m-%d') || '/Case' || l_linenumber || '/' || {_camera_sql('l_suppkey')}
               || '/' || l_orderkey || '_' || l_partkey
               || CASE l_returnflag WHEN 'A' THEN '.seq' WHEN 'R' THEN '.mp4' ELSE '.seq.idx' END AS path,
               CAST(round(l_extendedprice * 10000) AS BIGINT) AS length
        FROM lineitem"""),
    "keyed_files": (("asset_files",), r"""
        SELECT path, length,
               CASE WHEN CAST(regexp_extract(path, '^DATA_(\d\d)', 1) AS INT) <= 69 THEN '20' ELSE '19' END
               || regexp_extract(path, '^DATA_(\d\d-\d\d-\d\d)', 1) AS recording_date,
               CAST(regexp_extract(path, '/Case(\d+)/', 1) AS INT) AS case_no,
               split_part(path, '/', 3) AS camera_name
        FROM asset_files"""),
    "stamped_files": ((), """
        SELECT strftime(l_shipdate, '%y-%m-%d') AS date,
               strftime(l_shipdate, '%Y-%m-%d') || '_' ||
               printf('%02d-%02d-%02d', ((l_partkey * 7 + l_suppkey) % 1440) // 60,
                      ((l_partkey * 7 + l_suppkey) % 1440) % 60, l_orderkey % 60) AS stamp,
               l_orderkey AS order_no, l_partkey AS part_no
        FROM lineitem"""),
    "bundle_files": ((), """
        SELECT DISTINCT 'raw/' || l_suppkey || '/' || l_orderkey ||
               CASE WHEN l_returnflag = 'A' THEN '.seq' WHEN l_returnflag = 'R' THEN '.seq.idx'
                    WHEN l_linestatus = 'O' THEN '.xml' ELSE '.aud' END AS path
        FROM lineitem"""),
    **{name: ((), f"""
        SELECT *, 'DATA_' || substr(recording_date, 3, 8) || '/Case' || case_no || '/' || camera_name || '/' || part_no
                  || '.mp4' AS path
        FROM (SELECT strftime(l_shipdate, '%Y-%m-%d') AS recording_date,
                     l_linenumber + CASE WHEN l_linestatus <> '{flag}' AND l_linenumber > 3
                                    THEN {10 if flag == "O" else 20} ELSE 0 END AS case_no,
                     {_camera_sql('l_suppkey')} AS camera_name,
                     CASE WHEN max(l_discount) > 0.01 THEN CAST(floor(max(l_extendedprice) / 100) AS BIGINT) END AS size_mb,
                     max(l_quantity) AS duration_minutes, min(l_partkey) AS part_no,
                     round(max(l_tax) * 100 - 4, 1) AS offset_seconds
              FROM lineitem GROUP BY 1, 2, 3)""")
       for name, flag in (("seq_status", "O"), ("mp4_status", "F"))},
    "details": ((), """
        SELECT strftime(l_shipdate, '%Y-%m-%d') AS recording_date, l_linenumber AS case_no,
               max(l_partkey) AS anesthesiology_key
        FROM lineitem GROUP BY 1, 2"""),
    "people": ((), """
        SELECT p_partkey AS anesthesiology_key, p_name AS name,
               strftime(DATE '1990-01-01' + CAST(p_partkey % 4000 AS INT), '%Y-%m-%d') AS anesthesiology_start_date,
               CASE WHEN p_size <= 25 THEN strftime(DATE '1990-01-01' + CAST(p_partkey % 4000 AS INT) + 1800, '%Y-%m-%d')
               END AS grade_a_date
        FROM part"""),
    "labelled": (("details",), """
        SELECT recording_date, case_no + CASE WHEN doc_id IS NULL THEN 100 ELSE 0 END AS case_no
        FROM details LEFT JOIN labels ON anesthesiology_key = doc_id"""),
    "case_stats": (("mp4_status",), """
        SELECT recording_date, case_no, count(*) AS cameras_count FROM mp4_status WHERE size_mb IS NOT NULL
        GROUP BY 1, 2"""),
    **{name: ((), f"""
        SELECT strftime(o_orderdate, '%Y-%m-%d') AS recording_date,
               o_orderkey + CASE WHEN o_orderpriority = '{own}' THEN {OWN} ELSE 0 END AS case_no,
               {_camera_sql('o_custkey')} AS camera_name,
               CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(floor(o_totalprice / 1000) AS BIGINT) {bump} END AS size_mb,
               'Recordings/' || o_custkey || '/' || o_orderkey || '.mp4' AS path
        FROM orders""")
       for name, own, bump in (
           ("status_a", "1-URGENT", ""),
           ("status_b", "2-HIGH", "+ CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END"))},
    "frames": ((), """
        SELECT CAST(user_id AS VARCHAR) AS file, event_id AS rec_no, 1024 + event_id * 1000 AS "offset",
               CAST(CASE WHEN event_type = 'error' THEN 8 ELSE 992 END AS BIGINT) AS size,
               epoch_us(ts) // 1000000 AS ts_seconds,
               ((epoch_us(ts) % 1000) << 16) + (epoch_us(ts) % 1000000) // 1000 AS ts_sub,
               (event_id // 100) % 97 AS frame_number,
               CAST(epoch_us(ts) // 1000000 AS DOUBLE) + ((epoch_us(ts) % 1000000) // 1000) / 1000.0
                   + (epoch_us(ts) % 1000) / 1000000.0 AS t
        FROM events"""),
    "frame_rates": ((), """
        SELECT CAST(user_id AS VARCHAR) AS file,
               CASE WHEN count(*) FILTER (event_type = 'error') > 10 THEN 0.00005 ELSE 0.0 END::DOUBLE AS fps,
               max(event_id) * 1000 + 1500 AS file_size,
               count(*) FILTER (event_type <> 'signup') AS allocated_frames
        FROM events GROUP BY 1"""),
    "diffs": (("frames",), """
        SELECT *, frame_number - lag(frame_number) OVER (PARTITION BY file ORDER BY rec_no) AS d,
               t - lag(t) OVER (PARTITION BY file ORDER BY rec_no) AS td,
               lag("offset") OVER (PARTITION BY file ORDER BY rec_no) AS prev_offset,
               lag(size) OVER (PARTITION BY file ORDER BY rec_no) AS prev_size
        FROM frames"""),
    "enriched": (("diffs", "frame_rates"), """
        SELECT file, fps, idx_frames, dropped_frames, dropped_frames / (idx_frames + dropped_frames) AS drop_rate,
               first_frame_no, last_frame_no, last_frame_no - first_frame_no AS frame_span, n_duplicates,
               n_counter_resets, first_frame_time, last_frame_time, max_time_gap_ms,
               last_frame_time - first_frame_time AS actual_duration,
               CASE WHEN fps > 0 THEN idx_frames / fps END AS expected_duration,
               CASE WHEN fps > 0 THEN (last_frame_time - first_frame_time - idx_frames / fps) * 1000 END AS time_drift_ms
        FROM (SELECT file, count(*) AS idx_frames,
                     CAST(coalesce(sum(d - 1) FILTER (d > 1), 0) AS BIGINT) AS dropped_frames,
                     arg_min(frame_number, rec_no) AS first_frame_no, arg_max(frame_number, rec_no) AS last_frame_no,
                     count(*) FILTER (d = 0) AS n_duplicates, count(*) FILTER (d < 0) AS n_counter_resets,
                     arg_min(t, rec_no) AS first_frame_time, arg_max(t, rec_no) AS last_frame_time,
                     max(td) * 1000 AS max_time_gap_ms
              FROM diffs GROUP BY file) JOIN frame_rates USING (file)"""),
    "events_k": ((), f"""
        SELECT *, {_K} AS k, (epoch_us(ts) // 1000000 - {ORIGIN}) // 3600 AS hour,
               CASE event_type WHEN 'click' THEN 1 WHEN 'error' THEN 2 WHEN 'purchase' THEN 3 WHEN 'signup' THEN 4
               ELSE 5 END AS kind
        FROM events"""),
    "tracks": (("events_k",), """
        SELECT video, Track_ID, Frame_ID, Timestamp, ordinal, conf,
               x - k / 10.0 AS Left_Shoulder_x, y - k / 10.0 AS Left_Shoulder_y,
               CASE WHEN k > 50 THEN conf ELSE 0.0 END AS Left_Shoulder_conf,
               x + k / 10.0 AS Right_Shoulder_x, y - k / 10.0 AS Right_Shoulder_y,
               CASE WHEN k > 50 THEN conf ELSE 0.0 END AS Right_Shoulder_conf,
               x - k / 10.0 AS Left_Hip_x, y + k / 10.0 AS Left_Hip_y,
               CASE WHEN k > 25 THEN conf ELSE 0.0 END AS Left_Hip_conf,
               x + k / 10.0 AS Right_Hip_x, y + k / 10.0 AS Right_Hip_y,
               CASE WHEN k > 25 THEN conf ELSE 0.0 END AS Right_Hip_conf
        FROM (SELECT CAST(user_id AS VARCHAR) AS video, kind * 10 + hour // 168 AS Track_ID, hour AS Frame_ID,
                     hour / 30.0::DOUBLE AS Timestamp, event_id AS ordinal, value AS x,
                     CASE WHEN k >= 10 THEN CAST(k AS DOUBLE) END AS y, k, (event_id % 100) / 100.0::DOUBLE AS conf
              FROM events_k)"""),
    "centroids": (("tracks",), """
        SELECT *, list_avg(list_filter([Left_Shoulder_x, Right_Shoulder_x, Left_Hip_x, Right_Hip_x], lambda v: v IS NOT NULL))
                      AS centroid_x,
               list_avg(list_filter([Left_Shoulder_y, Right_Shoulder_y, Left_Hip_y, Right_Hip_y], lambda v: v IS NOT NULL))
                      AS centroid_y
        FROM tracks"""),
    "dets": (("events_k",), """
        SELECT CAST(user_id AS VARCHAR) AS video, hour AS frame, event_id AS det_no, value AS x1, CAST(k AS DOUBLE) AS y1,
               value + 20 + k / 2.0::DOUBLE AS x2, CAST(k + 40 AS DOUBLE) AS y2, (event_id % 100) / 100.0::DOUBLE AS conf,
               CASE WHEN k > 80 THEN 1 ELSE 0 END AS cls, event_type
        FROM events_k"""),
    "sessions": (("events_k",), """
        SELECT strftime(ts, '%Y-%m-%d') AS recording_date, CAST(user_id AS INT) AS case_no, event_type AS camera_name,
               ts, strftime(ts, '%Y-%m-%d %H') AS tick, value AS position,
               CASE WHEN k >= 95 THEN 400.0 ELSE 0.0 END::DOUBLE + (k - 50) / 10.0::DOUBLE AS offset_seconds,
               event_type = 'click' AS is_reference, event_id
        FROM events_k"""),
    "crops": ((), """
        SELECT DISTINCT l_suppkey || '_v' || printf('%02d', l_linenumber) || '_' || l_orderkey ||
               CASE WHEN l_discount > 0.09 THEN '.JPG' ELSE '.jpg' END AS name
        FROM lineitem"""),
    "parsed_crops": (("crops",), r"""
        SELECT name, CAST(regexp_extract(name, '^(\d+)_v(\d+)_(\d+)\.jpg$', 1) AS INT) AS case_no,
               CAST(regexp_extract(name, '^(\d+)_v(\d+)_(\d+)\.jpg$', 2) AS INT) AS video_idx,
               CAST(regexp_extract(name, '^(\d+)_v(\d+)_(\d+)\.jpg$', 3) AS BIGINT) AS frame_id
        FROM crops WHERE regexp_matches(name, '^(\d+)_v(\d+)_(\d+)\.jpg$')"""),
    "reid": ((), """
        SELECT label AS identity, vec_id AS image,
               list_transform(CAST(embedding AS DOUBLE[]),
                   lambda v: v / sqrt(list_inner_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])))) AS u
        FROM embeddings"""),
    "logs": ((), """
        SELECT event_id, 'frame=  ' || event_id || ' fps= ' || CAST(value AS VARCHAR) || ' q=28.0 size=N/A speed=1.5x' AS line,
               CASE WHEN event_type = 'error' THEN '{"format": {}}'
               ELSE '{"format": {"duration": "' || CAST(value AS VARCHAR) || '"}}' END AS report
        FROM events"""),
    "intervals": ((), """
        SELECT o_orderkey AS video,
               1500.0::DOUBLE + o_custkey % 3000 + CASE WHEN o_orderstatus = 'F' THEN 4000.0 ELSE 0.0 END::DOUBLE AS duration_s,
               printf('%d:%02d:%02d', s1 // 3600, s1 % 3600 // 60, s1 % 60) AS start_1, CAST(e1 AS VARCHAR) AS end_1,
               CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(s2 AS VARCHAR) END AS start_2,
               CASE WHEN o_orderpriority = '2-HIGH' THEN 'end' ELSE CAST(s2 + len AS VARCHAR) END AS end_2,
               CASE WHEN o_orderstatus <> 'P' THEN CAST(s2 + len + o_custkey % 300 AS VARCHAR) END AS start_3,
               CASE WHEN o_orderstatus <> 'P' THEN CAST(s2 + len + o_custkey % 300 + 2 * len AS VARCHAR) END AS end_3,
               s1, e1, s2, len, s2 + len AS e2, s2 + len + o_custkey % 300 AS s3, s2 + len + o_custkey % 300 + 2 * len AS e3,
               o_orderpriority, o_orderstatus, o_custkey
        FROM (SELECT *, o_custkey % 5000 AS s1, o_custkey % 5000 + CAST(floor(o_totalprice / 1000) AS BIGINT) AS e1,
                     o_custkey % 5000 + CAST(floor(o_totalprice / 1000) AS BIGINT) + o_custkey % 700 - 200 AS s2,
                     CAST(floor(o_totalprice / 1000) AS BIGINT) AS len
              FROM orders)"""),
    "valid": (("intervals",), """
        SELECT *, row_number() OVER (PARTITION BY video ORDER BY start_s, case_no) AS i,
               count(*) OVER (PARTITION BY video) AS n, lag(end_s) OVER (PARTITION BY video ORDER BY start_s, case_no) AS before_end,
               lead(start_s) OVER (PARTITION BY video ORDER BY start_s, case_no) AS after_start,
               last_value(end_s) OVER (PARTITION BY video ORDER BY start_s, case_no
                   ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_end
        FROM (SELECT video, duration_s, case_no, CAST(a AS DOUBLE) AS start_s, least(CAST(b AS DOUBLE), duration_s) AS end_s
              FROM (SELECT video, duration_s, 1 AS case_no, s1 AS a, CAST(e1 AS DOUBLE) AS b FROM intervals
                    UNION ALL SELECT video, duration_s, 2, s2, CASE WHEN end_2 = 'end' THEN duration_s ELSE e2 END
                    FROM intervals WHERE start_2 IS NOT NULL
                    UNION ALL SELECT video, duration_s, 3, s3, CAST(e3 AS DOUBLE) FROM intervals WHERE start_3 IS NOT NULL)
              WHERE a < b AND a <= duration_s)"""),
    "trimmed": (("valid",), """
        SELECT *, CASE WHEN duration_s - last_end > 3600 THEN last_end + 3600 ELSE duration_s END AS trimmed_s
        FROM valid"""),
}


def with_views(names: str, body: str) -> str:
    """SQL text `body` preceded by the named views and everything they build on."""
    needed: list[str] = []

    def add(name: str) -> None:
        for parent in VIEWS_SQL[name][0]:
            add(parent)
        if name not in needed:
            needed.append(name)

    for n in names.split():
        add(n)
    if not needed:
        return body
    ctes = ", ".join(f"{n} AS ({VIEWS_SQL[n][1]})" for n in needed)
    # a body that starts with a comma adds views of its own, possibly recursive ones
    return f"WITH RECURSIVE {ctes} {body}"
