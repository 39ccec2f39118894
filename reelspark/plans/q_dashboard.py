"""Queries behind the dashboard."""

from pyspark.sql import functions as F

from reelspark.operators import dashboard as D
from reelspark.plans import bindings as B
from reelspark.plans.registry import query, rounded


def stats(s, d):
    return D.recording_statistics(B.mp4_status(s, d))


@query("recording_statistics", "SELECT * FROM case_stats", "case_stats")
def _(s, d):
    return stats(s, d)


@query("recording_kpis", """
    SELECT count(*) AS recordings, count(DISTINCT recording_date) AS surgery_days, round_even(avg(cameras_count), 1) AS avg_cameras,
           max(cameras_count) AS max_cameras, min(recording_date) AS first_date, max(recording_date) AS last_date
    FROM case_stats""", "case_stats")
def _(s, d):
    return D.recording_kpis(stats(s, d))


@query("camera_count_distribution", """
    SELECT cameras_count, count(*) AS recordings, cameras_count || ' cam' AS label FROM case_stats GROUP BY 1""", "case_stats")
def _(s, d):
    return D.camera_count_distribution(stats(s, d))


@query("yearly_overview", """
    SELECT CAST(left(recording_date, 4) AS INT) AS year, count(*) AS recordings, count(DISTINCT recording_date) AS surgery_days
    FROM case_stats GROUP BY 1""", "case_stats")
def _(s, d):
    return D.yearly_overview(stats(s, d))


@query("cases_per_day", """
    SELECT cases, count(*) AS days, cases || CASE WHEN cases = 1 THEN ' case' ELSE ' cases' END AS label
    FROM (SELECT count(*) AS cases FROM case_stats GROUP BY recording_date) GROUP BY 1""", "case_stats")
def _(s, d):
    return D.cases_per_day(stats(s, d))


@query("monthly_overview", """
    SELECT left(recording_date, 7) AS month, count(*) AS recordings, count(DISTINCT recording_date) AS surgery_days,
           round_even(avg(cameras_count), 1) AS avg_cameras FROM case_stats GROUP BY 1""", "case_stats")
def _(s, d):
    return D.monthly_overview(stats(s, d))


TAGGED = "SELECT * FROM (SELECT DISTINCT recording_date, case_no FROM labelled) JOIN case_stats USING (recording_date, case_no)"


@query("tagged_cases", TAGGED, "labelled case_stats")
def _(s, d):
    return D.tagged_cases(B.labelled(s, d), stats(s, d))


@query("labelled_overview", f"""
    SELECT count(*) AS labelled_cases, count(DISTINCT recording_date) AS labelled_days,
           round_even(avg(cameras_count), 1) AS avg_cameras,
           coalesce(round_even(count(DISTINCT recording_date) * 100.0 / (SELECT nullif(count(DISTINCT recording_date), 0)
                                                                       FROM case_stats), 0), 0)::DOUBLE AS coverage_pct
    FROM ({TAGGED})""", "labelled case_stats")
def _(s, d):
    return D.labelled_overview(D.tagged_cases(B.labelled(s, d), stats(s, d)), stats(s, d))


@query("labelled_by_month", f"""
    SELECT left(recording_date, 7) AS month, count(*) AS labelled_cases FROM ({TAGGED}) GROUP BY 1""", "labelled case_stats")
def _(s, d):
    return D.labelled_by_month(D.tagged_cases(B.labelled(s, d), stats(s, d)))


@query("merge_measures", f"""
    SELECT month, recordings, surgery_days, labelled_cases
    FROM (SELECT left(recording_date, 7) AS month, count(*) AS recordings, count(DISTINCT recording_date) AS surgery_days
          FROM case_stats GROUP BY 1)
    JOIN (SELECT left(recording_date, 7) AS month, count(*) AS labelled_cases FROM ({TAGGED}) GROUP BY 1) USING (month)""",
       "labelled case_stats")
def _(s, d):
    months = D.monthly_overview(stats(s, d)).drop("avg_cameras")
    return D.merge_measures(months, D.labelled_by_month(D.tagged_cases(B.labelled(s, d), stats(s, d))), ["month"])


@query("case_browser", """
    SELECT recording_date, case_no, coalesce(min(name), 'Unknown') AS provider, count(camera_name) AS camera_count,
           coalesce(max(duration_minutes) * 60, 0) AS total_duration
    FROM mp4_status LEFT JOIN details USING (recording_date, case_no) LEFT JOIN people USING (anesthesiology_key)
    GROUP BY 1, 2""", "mp4_status details people")
def _(s, d):
    return D.case_browser(B.mp4_status(s, d), B.details(s, d), B.people(s, d))


@query("newest_first", "SELECT recording_date, case_no, camera_name, size_mb FROM mp4_status", "mp4_status")
def _(s, d):
    return D.newest_first(B.mp4_status(s, d).select("recording_date", "case_no", "camera_name", "size_mb"))


@query("top_k", """
    SELECT recording_date, case_no, camera_name, size_mb FROM mp4_status WHERE size_mb IS NOT NULL
    ORDER BY size_mb DESC, recording_date, case_no, camera_name LIMIT 10""", "mp4_status")
def _(s, d):
    keys = ["recording_date", "case_no", "camera_name"]
    return D.top_k(B.mp4_status(s, d).select(*keys, "size_mb"), "size_mb", 10, keys)


@query("bottom_k", """
    SELECT recording_date, case_no, camera_name, size_mb FROM mp4_status WHERE size_mb IS NOT NULL
    ORDER BY size_mb, recording_date, case_no, camera_name LIMIT 10""", "mp4_status")
def _(s, d):
    keys = ["recording_date", "case_no", "camera_name"]
    return D.bottom_k(B.mp4_status(s, d).select(*keys, "size_mb"), "size_mb", 10, keys)


@query("head_n", """
    SELECT recording_date, case_no, camera_name, path FROM mp4_status ORDER BY 1, 2, 3 LIMIT 50""", "mp4_status")
def _(s, d):
    keys = ["recording_date", "case_no", "camera_name"]
    return D.head_n(B.mp4_status(s, d).select(*keys, "path"), keys, 50)


@query("keep_sorted", "SELECT case_no, recording_date, camera_name FROM mp4_status", "mp4_status")
def _(s, d):
    return D.keep_sorted(B.mp4_status(s, d).select("case_no", "recording_date", "camera_name"),
                         ["case_no", "recording_date", "camera_name"])
