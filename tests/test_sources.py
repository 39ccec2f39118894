"""Binary readers, listings, state files and sinks on small files."""

import hashlib
import json
import struct

import pytest
from pyspark.sql import functions as F

from reelspark import sources as S
from reelspark.operators import assets, catalog


def header(width=2048, height=1536, frames=44566, fps=30.0, fmt=8, at=1670135842, exposure=1000000, magic=0xFEED):
    raw = bytearray(1024)
    struct.pack_into("<I", raw, 0, magic)
    text = "Recorder 9.1\0".encode("utf-16-le")
    raw[36:36 + len(text)] = text
    for offset, v in ((548, width), (552, height), (572, frames), (620, fmt), (624, at), (636, exposure)):
        struct.pack_into("<I", raw, offset, v)
    struct.pack_into("<d", raw, 584, fps)
    return bytes(raw)


def record(offset, size, sec, ms, us, number):
    return struct.pack("<QIIIIII", offset, size, sec, us << 16 | ms, 0, 0, number)


@pytest.fixture
def archive(tmp_path):
    folder = tmp_path / "DATA_22-12-04" / "Case1" / "Monitor"
    folder.mkdir(parents=True)
    index, body, at = b"", b"", 1024
    for i in range(100):
        payload = bytes([i]) * (20 + i)
        size = len(payload) + 8
        number = 65500 + i  # the low counter word wraps inside the file
        body += struct.pack("<IHH", size, 30, number & 0xFFFF) + payload + struct.pack("<IHH", 1670135842 + i, i, 2 * i)
        index += record(at, size, 1670135842 + i, i, 2 * i, number)
        at += size + 8
    (folder / "a.123.seq").write_bytes(header() + body + b"\0" * 64)
    (folder / "a.123.SEQ.idx").write_bytes(index + b"tail")
    (folder / "short.seq").write_bytes(b"tiny")
    (folder / "other.Seq").write_bytes(header(magic=7))
    (folder / "empty.seq.idx").write_bytes(b"")
    (folder / "blank.seq.idx").write_bytes(record(1024, 0, 1, 0, 0, 1))
    return tmp_path


def test_listing_ignores_case(spark, archive):
    names = {r["path"].split("/")[-1] for r in S.scan_files(spark, str(archive), ".seq").collect()}
    assert names == {"a.123.seq", "short.seq", "other.Seq"}
    assert S.scan_files(spark, str(archive), levels=0).count() == S.scan_files(spark, "file://" + str(archive)).count() == 6
    assert S.scan_files(spark, str(archive / "nowhere")).count() == 0
    keyed = assets.parse_recording_key(S.scan_files(spark, str(archive), ".seq"))
    assert keyed.select("recording_date", "case_no", "camera_name").distinct().collect() == [("2022-12-04", 1, "Monitor")]


def test_headers(spark, archive):
    got = {r["path"].split("/")[-1]: r for r in S.scan_seq_headers(S.scan_files(spark, str(archive), ".seq")).collect()}
    r = got["a.123.seq"]
    assert (r["header_ok"], r["description"], r["width"], r["height"]) == (True, "Recorder 9.1", 2048, 1536)
    assert (r["allocated_frames"], r["fps"], r["compression_fmt"], r["rec_timestamp"]) == (44566, 30.0, 8, 0x638C4022)
    for bad in ("short.seq", "other.Seq"):
        assert got[bad]["header_ok"] is False and got[bad]["width"] is None


@pytest.mark.parametrize("range_records", [7, 1 << 18])
def test_index_and_rebuild_agree(spark, archive, range_records):
    idx = S.scan_files(spark, str(archive), ".idx")
    frames = S.scan_frame_index(idx, range_records=range_records).filter(F.col("file").contains("a.123"))
    rows = [tuple(r)[1:] for r in frames.orderBy("rec_no").collect()]
    assert len(rows) == 100 and rows[3][:4] == (3, 1024 + sum(20 + i + 16 for i in range(3)), 31, 1670135845)
    seq = S.scan_files(spark, str(archive), ".seq").filter(F.col("path").contains("a.123"))
    rebuilt = [tuple(r)[1:] for r in S.rebuild_frame_index(seq).orderBy("rec_no").collect()]
    # the container holds only the low counter word, so the first value is known modulo 65536
    assert rebuilt == rows


def test_empty_records(spark, archive):
    idx = S.scan_files(spark, str(archive), ".idx")
    assert S.scan_frame_index(idx).count() == 101
    assert S.scan_frame_index(idx, drop_empty=True).count() == 100


def test_endpoints(spark, archive):
    got = {r["path"].split("/")[-1]: r for r in S.scan_index_endpoints(S.scan_files(spark, str(archive), ".idx")).collect()}
    full = got["a.123.SEQ.idx"]
    assert (full["frame_count"], full["idx_file_size"]) == (100, 3204)
    assert full["t_start"] == 1670135842.0 and full["t_end"] == pytest.approx(1670135941.099198)
    assert got["empty.seq.idx"]["frame_count"] is None and got["blank.seq.idx"]["t_start"] is None


def test_hashes(spark, archive):
    seq = S.scan_files(spark, str(archive), ".seq").filter(F.col("path").contains("a.123"))
    want = hashlib.sha256((archive / "DATA_22-12-04/Case1/Monitor/a.123.seq").read_bytes()).hexdigest()
    assert assets.hash_files(seq, chunk=100).first()["sha256"] == want


def test_crops_and_failures(spark, tmp_path):
    for n in ("42_v01_000123.jpg", "case.jpg", "7_v02_5.JPG"):
        (tmp_path / n).write_bytes(b"x")
    got = {r["name"]: r["case_no"] for r in S.scan_crops(spark, str(tmp_path)).collect()}
    assert got == {"42_v01_000123.jpg": 42, "case.jpg": None, "7_v02_5.JPG": None}


def test_state_round_trip(spark, tmp_path):
    path = tmp_path / "state.json"
    assert S.read_processed_state(spark, str(path)).count() == 0
    path.write_text("{ broken")
    assert S.read_processed_state(spark, str(path)).count() == 0
    path.write_text(json.dumps({"a.mp4": {"output_path": "b.mp4", "status": "success", "timestamp": "t"}}, indent=1))
    assert [tuple(r) for r in S.read_processed_state(spark, str(path)).collect()] == [("a.mp4", "b.mp4", "success", "t")]


def test_run_results(spark, tmp_path):
    (tmp_path / "r.json").write_text(json.dumps({
        "run_name": "a", "config": {"epochs": 2, "lr": 0.1}, "best_loss": 1.0, "final_loss": 1.5, "loss_history": [2.0, 1.0]}))
    runs = S.read_run_results(spark, str(tmp_path))
    assert runs.first()["config"]["epochs"] == 2
    assert [tuple(r) for r in S.loss_curve(runs).collect()] == [("a", 0, 2.0), ("a", 1, 1.0)]


def test_text_and_csv_sinks(spark, tmp_path):
    df = spark.createDataFrame([(i, f"n{i}") for i in range(50)], "id int, name string")
    line = F.format_string("%03d %s", "id", "name")
    S.write_report(df.repartition(5), line, str(tmp_path / "report"), ["id"])
    parts = sorted((tmp_path / "report").glob("part-*"))
    assert "".join(p.read_text() for p in parts).splitlines() == [f"{i:03d} n{i}" for i in range(50)]
    for _ in range(2):
        S.append_run_log(df, line, str(tmp_path / "log"))
    assert spark.read.text(str(tmp_path / "log")).count() == 100
    S.export_csv(df, str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 50
    S.write_json(df.select(F.struct("id", "name").alias("run")), str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).select("run.id").count() == 50
    S.write_parquet(df.withColumn("helper", F.lit(1)), str(tmp_path / "pq"), drop=["helper"], partition_by=["name"])
    assert sorted(spark.read.parquet(str(tmp_path / "pq")).columns) == ["id", "name"]


def test_timecodes_keep_order(spark, tmp_path):
    df = spark.range(1000).select(
        F.concat(F.lit("f"), F.col("id") % 2).alias("file"), F.col("id").alias("rec_no"), F.lit(100).alias("ts_seconds") + F.col("id"),
        F.lit(0).alias("ts_sub"))
    df = df.toDF("file", "rec_no", "ts_seconds", "ts_sub").withColumn("frame_number", F.col("rec_no"))
    S.write_timecodes(df, str(tmp_path / "tc"))
    parts = sorted((tmp_path / "tc" / "file=f1").glob("part-*"))
    lines = "".join(p.read_text() for p in parts).splitlines()
    assert lines[0].startswith("#") and lines[1:3] == ["0.000", "2000.000"] and len(lines) == 501


def test_keypoint_scan(spark, tmp_path):
    spark.createDataFrame([(1, 0.1, 2, 5.0)], "Frame_ID bigint, Timestamp double, Track_ID bigint, Nose_x double").write.parquet(
        str(tmp_path / "kp"))
    kp = S.read_keypoints(spark, str(tmp_path / "kp"))
    assert len(kp.columns) == 54 and kp.first()["Nose_x"] == 5.0


def test_partition_upsert(spark, tmp_path):
    path = str(tmp_path / "table")
    keys = ["recording_date", "case_no"]
    schema = "recording_date string, case_no int, size_mb int, note string"
    catalog.overwrite_partitions(spark.createDataFrame([("2024-01-01", 1, 5, "keep"), ("2024-01-02", 1, 6, "keep")], schema), path)
    before = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "table" / "recording_date=2024-01-02").glob("*.parquet")}
    updates = spark.createDataFrame([("2024-01-01", 1, 9), ("2024-01-01", 2, 1)], "recording_date string, case_no int, size_mb int")
    catalog.upsert_partitions(spark, path, updates, keys, ["size_mb"], schema=schema)
    got = {(r["recording_date"], r["case_no"]): (r["size_mb"], r["note"]) for r in spark.read.schema(schema).parquet(path).collect()}
    assert got == {("2024-01-01", 1): (9, "keep"), ("2024-01-01", 2): (1, None), ("2024-01-02", 1): (6, "keep")}
    after = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "table" / "recording_date=2024-01-02").glob("*.parquet")}
    assert before == after


def test_delete_needs_a_key(spark):
    with pytest.raises(ValueError):
        catalog.delete_by_key(spark.range(1), spark.range(1), [])
