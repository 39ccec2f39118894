"""Queries over catalogue tables."""

from pyspark.sql import functions as F

from reelspark.operators import catalog as C
from reelspark.plans import bindings as B
from reelspark.plans.registry import query, rounded
from reelspark.sources import load_table

RK = ["recording_date", "case_no", "camera_name"]
KEY = ", ".join(RK)
UPSERT = """
    SELECT coalesce(a.recording_date, b.recording_date) AS recording_date, coalesce(a.case_no, b.case_no) AS case_no,
           coalesce(a.camera_name, b.camera_name) AS camera_name,
           CASE WHEN b.case_no IS NOT NULL THEN b.size_mb ELSE a.size_mb END AS size_mb, {path} AS path
    FROM status_a a FULL JOIN status_b b USING (recording_date, case_no, camera_name)"""


def both(s, d):
    return B.status_a(s, d), B.status_b(s, d)


@query("load_table", f"SELECT {KEY}, size_mb, path FROM status_a", "status_a")
def _(s, d):
    B.status_a(s, d).createOrReplaceTempView("reelspark_seq_status")
    schema = "recording_date string, case_no bigint, camera_name string, size_mb bigint, path string"
    missing = load_table(s, "reelspark_no_such_table", schema)
    return load_table(s, "reelspark_seq_status", schema).unionByName(missing)


@query("insert_rows", f"""
    SELECT {KEY}, size_mb, path FROM status_a
    UNION ALL SELECT recording_date, case_no, camera_name, NULL, CASE WHEN size_mb IS NOT NULL THEN path END FROM status_b
    """, "status_a status_b")
def _(s, d):
    a, b = both(s, d)
    typed = b.withColumn("path", F.when(F.col("size_mb").isNull(), "").otherwise(F.col("path")))
    return C.insert_rows(a, typed, generated=["size_mb"])


@query("delete_by_key", f"""
    SELECT {KEY}, size_mb, path FROM status_a a WHERE NOT EXISTS (SELECT 1 FROM status_b b WHERE b.size_mb IS NULL
        AND b.recording_date = a.recording_date AND b.case_no = a.case_no AND b.camera_name = a.camera_name)""",
       "status_a status_b")
def _(s, d):
    a, b = both(s, d)
    return C.delete_by_key(a, b.filter("size_mb IS NULL"), RK)


@query("upsert_managed", UPSERT.format(path="a.path"), "status_a status_b")
def _(s, d):
    a, b = both(s, d)
    return C.upsert_managed(a, b, RK, ["size_mb"])


@query("upsert_all", f"""
    SELECT coalesce(a.case_no, b.case_no) AS case_no, coalesce(a.recording_date, b.recording_date) AS recording_date,
           CASE WHEN b.case_no IS NOT NULL THEN b.rate ELSE a.rate END AS rate,
           CASE WHEN b.case_no IS NOT NULL THEN b.has_file ELSE a.has_file END AS has_file
    FROM (SELECT *, size_mb * 1.0::DOUBLE AS rate, CASE WHEN size_mb > 100 THEN 1 ELSE 0 END AS has_file FROM status_a) a
    FULL JOIN (SELECT *, CASE WHEN size_mb >= 50 THEN size_mb * 1.0::DOUBLE END AS rate,
                      CASE WHEN size_mb > 100 THEN 1 WHEN size_mb <= 100 THEN 0 END AS has_file
               FROM status_b WHERE camera_name <> 'Monitor') b USING (case_no, recording_date)""",
       "status_a status_b")
def _(s, d):
    a, b = both(s, d)
    table = a.select("case_no", "recording_date", (F.col("size_mb") * 1.0).alias("rate"),
                     F.when(F.col("size_mb") > 100, 1).otherwise(0).alias("has_file"))
    # Monitor rows lose their key, small sizes become NaN, the flag arrives as a boolean
    updates = b.select(
        F.when(F.col("camera_name") != "Monitor", F.col("case_no")).alias("case_no"), "recording_date",
        F.when(F.col("size_mb") >= 50, F.col("size_mb") * 1.0).otherwise(F.lit(float("nan"))).alias("rate"),
        (F.col("size_mb") > 100).alias("has_file"))
    return C.upsert_all(table, updates, ["case_no", "recording_date"])


@query("skipped_rows", "SELECT count(*) FILTER (camera_name = 'Monitor') AS skipped FROM status_b", "status_b")
def _(s, d):
    rows = B.status_b(s, d).withColumn("case_no", F.when(F.col("camera_name") != "Monitor", F.col("case_no")))
    return C.skipped_rows(rows, RK)


@query("upsert_partial", """
    SELECT coalesce(a.case_no, b.case_no) AS case_no, a.path,
           CASE WHEN b.case_no IS NOT NULL THEN b.size_mb * 7 ELSE a.size_mb END AS idx_frames
    FROM status_a a FULL JOIN status_b b USING (recording_date, case_no, camera_name)""", "status_a status_b")
def _(s, d):
    a, b = both(s, d)
    table = a.withColumnRenamed("size_mb", "idx_frames")
    updates = b.select(*RK, (F.col("size_mb") * 7).alias("idx_frames"), "path")
    return C.upsert_partial(table, updates).select("case_no", "path", "idx_frames")


@query("update_else_insert", UPSERT.format(path="CASE WHEN b.case_no IS NOT NULL THEN b.path ELSE a.path END"),
       "status_a status_b")
def _(s, d):
    a, b = both(s, d)
    return C.update_else_insert(a, b, RK, ["size_mb", "path"])


@query("affected_counts", """
    SELECT count(a.case_no) AS updated, count(*) - count(a.case_no) AS inserted
    FROM status_b b LEFT JOIN status_a a USING (recording_date, case_no, camera_name)""", "status_a status_b")
def _(s, d):
    return C.affected_counts(*both(s, d), RK)


@query("update_offsets", """
    , u AS (SELECT recording_date, case_no, CASE WHEN camera_name = 'Monitor' THEN 'monitor/' ELSE camera_name END AS name,
                   offset_seconds + 1 AS v FROM mp4_status),
    un AS (SELECT u.* FROM u LEFT JOIN mp4_status m ON m.recording_date = u.recording_date AND m.case_no = u.case_no
                AND m.camera_name = u.name WHERE m.case_no IS NULL)
    SELECT m.recording_date, m.case_no, m.camera_name, round(coalesce(
               (SELECT arg_max(v, name) FROM un WHERE un.recording_date = m.recording_date AND un.case_no = m.case_no
                    AND contains(lower(m.path), lower(un.name))),
               (SELECT v FROM u WHERE u.recording_date = m.recording_date AND u.case_no = m.case_no AND u.name = m.camera_name),
               m.offset_seconds), 6) AS offset_seconds
    FROM mp4_status m""", "mp4_status")
def _(s, d):
    t = B.mp4_status(s, d)
    name = F.when(F.col("camera_name") == "Monitor", "monitor/").otherwise(F.col("camera_name"))
    updates = t.select("recording_date", "case_no", name.alias("camera_name"),
                       (F.col("offset_seconds") + 1).alias("offset_seconds"))
    return rounded(C.update_offsets(t, updates).select(*RK, "offset_seconds"))


@query("evolve_schema", f"""
    SELECT {KEY}, size_mb, NULL::DOUBLE AS drop_rate, NULL::BIGINT AS idx_frames FROM status_a""", "status_a")
def _(s, d):
    return C.evolve_schema(B.status_a(s, d), {"size_mb": "bigint", "drop_rate": "double", "idx_frames": "bigint"}, ["path"])


CHANGES = f"""
    SELECT b.recording_date, b.case_no, b.camera_name, b.size_mb,
           CASE WHEN a.case_no IS NULL THEN 'NEW' WHEN a.size_mb IS DISTINCT FROM b.size_mb THEN 'CHANGED'
                ELSE 'UNCHANGED' END AS change
    FROM status_b b LEFT JOIN status_a a USING (recording_date, case_no, camera_name)"""


@query("classify_changes", CHANGES, "status_a status_b")
def _(s, d):
    return C.classify_changes(*both(s, d), RK, ["size_mb"])


@query("change_counts", f"SELECT change, count(*) AS n FROM ({CHANGES}) GROUP BY 1", "status_a status_b")
def _(s, d):
    return C.change_counts(*both(s, d), RK, ["size_mb"])


@query("next_key", """
    SELECT coalesce(nullif(max(anesthesiology_key), 0), 0) + 1 AS next_key FROM people""", "people")
def _(s, d):
    return C.next_key(B.people(s, d), "anesthesiology_key")


@query("diff_tables", f"""
    SELECT coalesce(a.recording_date, b.recording_date) AS recording_date, coalesce(a.case_no, b.case_no) AS case_no,
           CASE WHEN b.case_no IS NULL THEN 'only_a' WHEN a.case_no IS NULL THEN 'only_b'
                WHEN a.size_mb IS DISTINCT FROM b.size_mb OR a.path <> b.path THEN 'differs' ELSE 'same' END AS result
    FROM status_a a FULL JOIN status_b b USING (recording_date, case_no, camera_name)""", "status_a status_b")
def _(s, d):
    return C.diff_tables(*both(s, d), [*RK, "absent_key"]).select("recording_date", "case_no", "result")


@query("diff_tables_whole_row", """
    SELECT result, count(*) AS n FROM (
        SELECT CASE WHEN min(side) = 'b' THEN 'only_b' WHEN max(side) = 'a' THEN 'only_a' ELSE 'same' END AS result
        FROM (SELECT 'a' AS side, camera_name, size_mb FROM status_a
              UNION ALL SELECT 'b', camera_name, size_mb FROM status_b) GROUP BY camera_name, size_mb)
    GROUP BY result""", "status_a status_b")
def _(s, d):
    a, b = both(s, d)
    rows = C.diff_tables(a.select("camera_name", "size_mb"), b.select("camera_name", "size_mb"), ["anesthesiology_key"])
    return rows.groupBy("result").agg(F.count(F.lit(1)).alias("n"))


@query("skip_known", """
    SELECT path FROM (SELECT *, CASE WHEN size_mb IS NOT NULL THEN camera_name END AS cam FROM status_b) b
    WHERE NOT EXISTS (SELECT 1 FROM status_a a WHERE a.recording_date = b.recording_date AND a.case_no = b.case_no
                      AND a.camera_name = b.cam)""", "status_a status_b")
def _(s, d):
    a, b = both(s, d)
    scan = b.withColumn("camera_name", F.when(F.col("size_mb").isNotNull(), F.col("camera_name")))
    return C.skip_known(scan, a).select("path")


@query("skip_processed", """
    SELECT b.path, EXISTS (SELECT 1 FROM status_a a WHERE a.path = b.path AND a.size_mb > 200) AS processed FROM status_b b
    """, "status_a status_b")
def _(s, d):
    a, b = both(s, d)
    state = a.filter("size_mb > 200").withColumn("path", F.regexp_replace("path", "/", "/./"))
    return C.skip_processed(b, state).select("path", "processed")


for _name, _here, _other, _cols in (
    ("missing_mp4", "seq_status", "mp4_status", KEY), ("missing_seq", "mp4_status", "seq_status", KEY),
    ("missing_mp4_cases", "seq_status", "mp4_status", "recording_date, case_no"),
):
    @query(_name, f"""
        SELECT {_cols} FROM {_here} WHERE size_mb IS NOT NULL
        EXCEPT SELECT {_cols} FROM {_other} WHERE size_mb IS NOT NULL""", "seq_status mp4_status")
    def _(s, d, _name=_name):
        fn = C.missing_seq if _name == "missing_seq" else C.missing_mp4
        return fn(B.seq_status(s, d), B.mp4_status(s, d), per_case=_name.endswith("cases"))


@query("seniority", """
    SELECT recording_date, case_no, anesthesiology_key, name,
           CAST((year(d) - year(s)) * 12 + month(d) - month(s) - CASE WHEN day(d) < day(s) THEN 1 ELSE 0 END AS INT)
               AS months_anesthetic_recording,
           CASE WHEN g <= d THEN 'attending' WHEN s IS NOT NULL THEN 'resident' END AS anesthetic_attending
    FROM (SELECT *, CAST(recording_date AS DATE) AS d, CAST(anesthesiology_start_date AS DATE) AS s,
                 CAST(grade_a_date AS DATE) AS g
          FROM details LEFT JOIN people USING (anesthesiology_key))""", "details people")
def _(s, d):
    return C.seniority(B.people(s, d), B.details(s, d))


SUMMARY = """
    SELECT count(*) AS row_count, CAST(coalesce(sum(size_mb), 0) AS BIGINT) AS total_size,
           count(DISTINCT recording_date) AS dates, count(DISTINCT (recording_date, case_no)) AS cases,
           count(DISTINCT camera_name) AS cameras FROM {t}"""


@query("table_summary", SUMMARY.format(t="mp4_status"), "mp4_status")
def _(s, d):
    return C.table_summary(B.mp4_status(s, d))


@query("compare_summaries", f"""
    SELECT measure, a, b, b - a AS difference
    FROM (UNPIVOT ({SUMMARY.format(t='status_a')}) ON COLUMNS(*) INTO NAME measure VALUE a)
    JOIN (UNPIVOT ({SUMMARY.format(t='status_b')}) ON COLUMNS(*) INTO NAME measure VALUE b) USING (measure)""",
       "status_a status_b")
def _(s, d):
    return C.compare_summaries(*both(s, d))


@query("key_values", """
    SELECT DISTINCT * FROM (SELECT 'recording_date' AS key_column, recording_date AS value FROM status_a
                            UNION ALL SELECT 'camera_name', camera_name FROM status_a
                            UNION ALL SELECT 'size_mb', CAST(size_mb AS VARCHAR) FROM status_a)
    WHERE value IS NOT NULL""", "status_a")
def _(s, d):
    return C.key_values(B.status_a(s, d), ["recording_date", "camera_name", "size_mb"])


@query("keys_only_in", f"SELECT {KEY} FROM status_a EXCEPT SELECT {KEY} FROM status_b", "status_a status_b")
def _(s, d):
    return C.keys_only_in(*both(s, d), RK)


@query("keys_common", f"SELECT {KEY} FROM status_a INTERSECT SELECT {KEY} FROM status_b", "status_a status_b")
def _(s, d):
    return C.keys_common(*both(s, d), RK)


@query("dedupe", """
    SELECT recording_date, camera_name, case_no, size_mb, path
    FROM (SELECT *, row_number() OVER (PARTITION BY recording_date, camera_name ORDER BY case_no, path) AS i FROM mp4_status)
    WHERE i = 1""", "mp4_status")
def _(s, d):
    rows = C.dedupe(B.mp4_status(s, d), ["recording_date", "camera_name"], ["case_no", "path"])
    return rows.select("recording_date", "camera_name", "case_no", "size_mb", "path")


@query("lookup_key", f"""
    SELECT {KEY}, size_mb, path FROM mp4_status WHERE case_no = 3 AND camera_name = 'Monitor'""", "mp4_status")
def _(s, d):
    rows = C.lookup_key(B.mp4_status(s, d), {"case_no": 3, "camera_name": "Monitor"})
    return rows.select(*RK, "size_mb", "path")


@query("coerce_types", """
    SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m-%d') END AS day,
           o_custkey AS customer, CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice END AS price,
           CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%H:%M:%S') END AS clock FROM orders""")
def _(s, d):
    o = B.table(s, d, "orders")
    texts = o.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", "").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).alias("day"),
        F.col("o_custkey").cast("string").alias("customer"),
        F.when(F.col("o_orderpriority") == "5-LOW", " ").otherwise(F.col("o_totalprice").cast("string")).alias("price"),
        F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).otherwise("none").alias("clock"))
    return C.coerce_types(texts, {"o_orderkey": "INTEGER", "day": "DATE", "customer": "INT", "price": "REAL", "clock": "TIME"})


@query("display_columns", """
    SELECT recording_date || ' Case' || case_no || ' ' || camera_name AS key_text, right(path, 12) AS path_text,
           size_mb || 'MB' AS size_text, printf('%.1fmin', duration_minutes) AS minutes_text FROM mp4_status""", "mp4_status")
def _(s, d):
    return C.display_columns(B.mp4_status(s, d), path="path", size="size_mb", minutes="duration_minutes", key=True, width=12)
