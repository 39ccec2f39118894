"""Documented examples of the scalar functions."""

import pytest
from pyspark.sql import functions as F

from reelspark import functions as S


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("name,want", [
    ("2024-01-07_14-30-45.seq", "24-01-07"), ("01-07-24_14-30-45.123.seq", "24-01-07"), ("video.seq", None),
])
def test_date_from_filename(spark, name, want):
    assert value(spark, S.date_from_filename(F.lit(name))) == want


@pytest.mark.parametrize("stem,want", [
    ("01-07-24_14-30-45.123", "2024-01-07 14:30:45"), ("2024-01-07_14-30-45", "2024-01-07 14:30:45"),
    ("01-07-70_00-00-01", "1970-01-07 00:00:01"), ("Monitor", None),
])
def test_timestamp_from_stem(spark, stem, want):
    assert value(spark, S.timestamp_from_stem(F.lit(stem)).cast("string")) == want


@pytest.mark.parametrize("code,want", [
    ("90", 90), ("130", 90), ("11500", 4500), ("90.5", 90.5), ("1:02:03", 3723), ("5 30", 330), ("007", 7), ("", None),
    ("x", None), ("1:2:3:4", None),
])
def test_jump_codes(spark, code, want):
    assert value(spark, S.jump_code_to_seconds(F.lit(code))) == want


@pytest.mark.parametrize("text,want", [("1:00:01.5", 3601.5), ("2:30", 150), ("45", 45), ("a:b", None)])
def test_hms(spark, text, want):
    assert value(spark, S.hms_to_seconds(F.lit(text))) == want


@pytest.mark.parametrize("name,want", [
    ("42_v01_000123.jpg", "42"), ("case42_v01_000123.jpg", "42"), ("C042_v01_000123.jpg", "042"), ("42_000123.jpg", "42"),
    ("abc_1.jpg", "abc"),
])
def test_case_from_filename(spark, name, want):
    assert value(spark, S.case_from_filename(F.lit(name))) == want


@pytest.mark.parametrize("name,date,want", [
    ("Mira Kaplan", "2015-10-01", "MK1510"), ("Ann", "2015-10-01", ""), ("a b c", "2001-02-03", "AC0102"), ("a b", "2001", ""),
])
def test_person_code(spark, name, date, want):
    assert value(spark, S.person_code(F.lit(name), F.lit(date))) == want


def test_frame_time_and_text(spark):
    packed = F.lit(500 << 16 | 250)
    assert value(spark, S.decode_frame_time(F.lit(1700000000), packed)) == pytest.approx(1700000000.2505, abs=1e-6)
    assert value(spark, S.unix_to_text(F.lit(1700000000.25))) == "2023-11-14 22:13:20.250000"
    assert value(spark, S.unix_to_text(F.lit(0.0))) is None


def test_description_is_utf16_up_to_nul(spark):
    raw = bytearray("Recorder 9 é\0junk".encode("utf-16-le"))
    assert value(spark, S.decode_description(F.lit(raw))) == "Recorder 9 é"


def test_hours_do_not_wrap(spark):
    assert value(spark, S.seconds_to_hms(F.lit(90061.9))) == "25:01:01"
    assert value(spark, S.seconds_to_hms(F.lit(3661.5), millis=True)) == "01:01:01.500"


def test_sync_status_examples(spark):
    apart = value(spark, S.sync_status(F.lit(10.5), F.lit(10.0), F.lit(0.0)))
    assert (apart["status"], apart["text"]) == ("out_of_sync", "+0.5s ahead")
    assert value(spark, S.sync_status(F.lit(10.2), F.lit(10.0), F.lit(0.0)))["status"] == "synced"
    assert value(spark, S.sync_status(F.lit(9.0), F.lit(10.0), F.lit(0.0)))["text"] == "-1.0s behind"


def test_relative_path_anchors(spark):
    path = F.lit("F:\\room\\Recordings\\DATA_23-02-06\\Case1\\Monitor\\m.mp4")
    assert value(spark, S.relative_path(path)) == "DATA_23-02-06/Case1/Monitor/m.mp4"
    assert value(spark, S.relative_path(F.lit("/a/b/c.mp4"))) == "c.mp4"
    assert value(spark, S.relative_path(F.lit("/a/b/c/d.mp4"), "data")) == "b/c/d.mp4"


def test_progress_line(spark):
    got = value(spark, S.parse_progress_line(F.lit("frame=  120 fps= 30 q=28 speed=1.5x"), 100))
    assert (got["frame"], got["fps"], got["speed"], got["percent"]) == (120, 30.0, 1.5, 100.0)
    assert value(spark, S.parse_progress_line(F.lit("noise")))["frame"] is None
