"""Streams give the rows of their batch twins."""

import datetime as dt

import pytest
from pyspark.sql import Row, functions as F

from reelspark.operators import reid, tracks
from reelspark.plans.q_streams import live_frames
from reelspark.plans.registry import QUERIES
from reelspark.operators.catalog import overwrite_partitions, touched_partitions
from reelspark.streaming import ingest_batch
from reelspark.streaming.live import STATUS_SCHEMA, _BurstKeeper, _StallKeeper
from reelspark.streaming import (
    capture_bursts_stream, duration_updates, ingest_status, live_pose, stall_alerts, sync_monitor,
)
from test_folds import burst_case

T0 = dt.datetime(2024, 1, 1)


def replay(spark, df, tmp_path, name, batches):
    """Write one file per batch and stream them in order."""
    for i, part in enumerate(batches):
        df.filter(part).coalesce(1).write.mode("append").parquet(str(tmp_path / name))
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / name))


def drain(out, tmp_path, name):
    q = (out.writeStream.format("memory").queryName(name).outputMode("append")
         .option("checkpointLocation", str(tmp_path / f"{name}_ck")).trigger(availableNow=True).start())
    q.awaitTermination(300)
    assert q.exception() is None
    return out.sparkSession.table(name)


def test_bursts_stream_equals_batch(spark, tmp_path):
    n, rows = 3000, []
    for v in range(3):
        good, usable = burst_case(v, n)
        rows += [(f"v{v}", f, f in good, f in usable) for f in range(n)]
    df = spark.createDataFrame(rows, "video string, frame bigint, good boolean, usable boolean")
    stream = replay(spark, df, tmp_path, "frames", [F.col("frame").between(a, a + 999) for a in range(0, n, 1000)])
    got = drain(capture_bursts_stream(stream), tmp_path, "bursts")
    videos = df.groupBy("video").agg((F.max("frame") + 1).alias("n_frames"))
    batch = reid.capture_bursts(df.filter("good").drop("good"), videos).filter("outcome <> 'open'")
    as_set = lambda d: sorted((r["video"], r["start_frame"], list(r["saved"]), r["outcome"]) for r in d.collect())
    assert as_set(got) == as_set(batch) != []


def test_open_bursts_come_out_at_the_end(spark, tmp_path):
    """With event time the stream gives the batch's bursts whole, and keeps nothing of ended videos."""
    n, rows = 1500, []
    for v in range(4):
        good, usable = burst_case(v + 10, n)
        rows += [(f"v{v}", f, f in good, f in usable, T0 + dt.timedelta(seconds=f)) for f in range(n - 7 * v)]
    rows.append(("clock", 0, False, False, T0 + dt.timedelta(days=9)))
    df = spark.createDataFrame(rows, "video string, frame bigint, good boolean, usable boolean, ts timestamp")
    parts = [F.col("frame").between(a, a + 499) & (F.col("video") != "clock") for a in range(0, n, 500)]
    stream = replay(spark, df, tmp_path, "timed", [*parts, F.col("video") == "clock"])
    got = drain(capture_bursts_stream(stream), tmp_path, "timed_bursts")
    videos = df.groupBy("video").agg((F.max("frame") + 1).alias("n_frames"))
    batch = reid.capture_bursts(df.filter("good").drop("good", "ts"), videos)
    as_set = lambda d: sorted((r["video"], r["start_frame"], list(r["saved"]), r["outcome"]) for r in d.collect())
    assert as_set(got) == as_set(batch) and any(r["outcome"] == "open" for r in got.collect())
    state = spark.read.format("statestore").option("stateVarName", "mode").load(str(tmp_path / "timed_bursts_ck"))
    assert {r.key[0] for r in state.select("key").collect()} <= {"clock"}


def test_bounded_run_equals_batch(spark):
    d = "/root/testdata/sf0.001"
    frames = live_frames(spark.read.parquet(f"{d}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp")))
    videos = frames.groupBy("video").agg((F.max("frame") + 1).alias("n_frames"))
    # the batch operator counts every frame number; here numbers of other videos are missing frames, which abort
    batch = reid.capture_bursts(frames.filter("good").select("video", "frame", "usable"), videos, gap=3, cooldown=12)
    as_set = lambda x: sorted((r["video"], r["start_frame"], list(r["saved"]), r["outcome"]) for r in x.collect())
    got = QUERIES["stream_bursts"](spark, d)
    # the video of the last event has not ended yet, so its open burst waits
    last = frames.orderBy(F.desc("ts")).first()["video"]
    ended = [r for r in as_set(batch) if (r[0], r[3]) != (last, "open")]
    assert as_set(got) == ended and any(r[3] == "open" for r in ended)


def test_live_pose_equals_batch(spark, tmp_path):
    frames = [0, 5, 50, 51, 90, 200]
    rows = [("v", t, f, T0 + dt.timedelta(seconds=f / 30), float(f), float(t)) for t in (1, 2) for f in frames if f % t == 0]
    rows.append(("end", 9, 9000, T0 + dt.timedelta(seconds=300), 0.0, 0.0))  # moves event time on
    df = spark.createDataFrame(rows, "video string, Track_ID bigint, Frame_ID bigint, ts timestamp, x double, y double")
    stream = replay(spark, df, tmp_path, "poses", [F.col("Frame_ID") < 60, F.col("Frame_ID").between(60, 1000), F.col("Frame_ID") > 1000])
    got = drain(live_pose(stream), tmp_path, "live").filter("video = 'v'")
    videos = spark.createDataFrame([("v", 100000)], "video string, n_frames bigint")
    batch = tracks.as_of_pose(df.drop("ts"), videos)
    cols = ["Track_ID", "frame", "pose_frame", "x", "y", "age"]
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, batch.select(cols).collect()))


def test_stall_alert(spark, tmp_path):
    def at(minutes):
        return T0 + dt.timedelta(minutes=minutes)

    rows = [("a", 10, at(0)), ("a", 10, at(30)), ("b", 10, at(0)), ("b", 20, at(55)), ("b", 30, at(100)), ("clock", 1, at(110))]
    df = spark.createDataFrame(rows, "job string, frame bigint, ts timestamp")
    stream = replay(spark, df, tmp_path, "progress", [F.col("ts") <= at(m) if m == 30 else F.col("ts") == at(m) for m in (30, 55, 100, 110)])
    got = drain(stall_alerts(stream), tmp_path, "alerts").collect()
    assert [(r["job"], r["frame"], r["stalled_since"]) for r in got] == [("a", 10, T0)]


def test_sync_monitor(spark, tmp_path):
    def tick(ms, camera, position, ref=False, alive=True, offset=0.0):
        return ("2024-01-01", 1, T0 + dt.timedelta(milliseconds=ms), camera, position, offset, ref, alive)

    rows = [tick(0, "ref", 10.0, True), tick(5, "near", 10.2), tick(10, "far", 10.1), tick(20, "far", 11.0),
            tick(30, "dead", 1.0, alive=False), tick(150, "lonely", 1.0), tick(60000, "ref", 1.0, True)]
    df = spark.createDataFrame(rows, "recording_date string, case_no int, ts timestamp, camera_name string, position double, "
                                     "offset_seconds double, is_reference boolean, alive boolean")
    # the last row arrives far behind the watermark of the batch before and is dropped
    more = spark.createDataFrame([tick(61000, "ref", 2.0, True)], df.schema)
    late = spark.createDataFrame([tick(1, "late", 5.0)], df.schema)
    all_rows = df.withColumn("part", F.lit(0)).unionByName(more.withColumn("part", F.lit(1))).unionByName(
        late.withColumn("part", F.lit(2)))
    stream = replay(spark, all_rows, tmp_path, "ticks", [F.col("part") == i for i in range(3)])
    got = {r["camera_name"]: r for r in drain(sync_monitor(stream), tmp_path, "monitor").collect() if r["tick"] < T0 + dt.timedelta(seconds=30)}
    assert got["near"]["status"] == "synced" and got["far"]["text"] == "+1.0s ahead"
    assert (got["dead"]["status"], got["dead"]["text"]) == ("error", "Exited")
    assert got["lonely"]["status"] is None and "late" not in got


def test_duration_updates(spark, tmp_path):
    rows = [("d", 1, "c", T0 + dt.timedelta(seconds=i), v) for i, v in enumerate((10.0, 10.5, 12.0, 12.9, 5.0))]
    df = spark.createDataFrame(rows, "recording_date string, case_no int, camera_name string, ts timestamp, duration double")
    stream = replay(spark, df, tmp_path, "dur", [F.col("ts") < T0 + dt.timedelta(seconds=2), F.col("ts") >= T0 + dt.timedelta(seconds=2)])
    got = drain(duration_updates(stream), tmp_path, "durations")
    assert sorted(r["duration"] for r in got.collect()) == [5.0, 10.0, 12.0]


@pytest.mark.parametrize("repeat", [1, 2])
def test_ingest_keeps_the_table(spark, tmp_path, repeat):
    mib = 1024 * 1024
    path = "DATA_24-01-0{}/Case1/Monitor/{}.seq"
    rows = [(path.format(1, "a"), 300 * mib, 1), (path.format(2, "b"), 10 * mib, 1), (path.format(1, "c"), 400 * mib, 2), ("x", 1, 2)]
    df = spark.createDataFrame(rows, "path string, length bigint, part int")
    table = str(tmp_path / "status")
    for i in range(repeat):  # a fresh checkpoint replays everything: the table must not change
        stream = replay(spark, df, tmp_path, f"files{i}", [F.col("part") == 1, F.col("part") == 2]).drop("part")
        q = ingest_status(stream, table, str(tmp_path / f"ck{i}"), str(tmp_path / "changes"))
        q.awaitTermination(300)
        assert q.exception() is None
    assert all(r["needs_compute"] and r["duration_minutes"] is None for r in spark.read.parquet(table).collect())
    got = {r["recording_date"].isoformat() if hasattr(r["recording_date"], "isoformat") else r["recording_date"]: (r["size_mb"], r["status"])
           for r in spark.read.parquet(table).collect()}
    assert got == {"2024-01-01": (400, 1), "2024-01-02": (10, 2)}


def ingested(spark, tmp_path, batches):
    """The table after each batch of (path, MB, scan version or None)."""
    table, out = str(tmp_path / "t"), []
    for k, rows in enumerate(batches):
        versioned = any(v is not None for *_, v in rows)
        df = spark.createDataFrame([(p, mb * 1024 * 1024, v) for p, mb, v in rows], "path string, length bigint, scan_version bigint")
        ingest_batch(table)(df if versioned else df.drop("scan_version"), k)
        stored = spark.read.schema(STATUS_SCHEMA).parquet(table)
        out.append({(r["recording_date"], r["case_no"]): r for r in stored.collect()})
    return out


def test_ingest_keeps_the_largest_and_its_metric(spark, tmp_path):
    path = "DATA_24-01-0{}/Case{}/Monitor/{}.seq"
    key = ("2024-01-01", 1)
    first, second = ingested(spark, tmp_path, [[(path.format(1, 1, "a"), 900, None), (path.format(2, 1, "z"), 7, None)],
                                               [(path.format(1, 1, "b"), 5, None)]])
    assert first[key].size_mb == second[key].size_mb == 900 and second[key].path.endswith("a.seq")
    # a metric that was computed stays while the size does
    table = str(tmp_path / "t")
    rows = spark.read.schema(STATUS_SCHEMA).parquet(table).withColumns(
        {"duration_minutes": F.lit(12.5), "needs_compute": F.lit(False)})
    rows.write.parquet(str(tmp_path / "copy"))
    overwrite_partitions(spark.read.schema(STATUS_SCHEMA).parquet(str(tmp_path / "copy")), table)
    third, fourth = ingested(spark, tmp_path, [[(path.format(1, 1, "b"), 5, None), (path.format(1, 2, "n"), 300, None)],
                                               [(path.format(1, 1, "c"), 901, None)]])
    assert (third[key].duration_minutes, third[key].needs_compute) == (12.5, False)
    assert third[("2024-01-01", 2)].needs_compute and third[("2024-01-02", 1)].duration_minutes == 12.5
    assert (fourth[key].size_mb, fourth[key].duration_minutes, fourth[key].needs_compute) == (901, None, True)


def test_a_later_scan_replaces_an_earlier_one(spark, tmp_path):
    path, key = "DATA_24-01-01/Case1/Monitor/{}.seq", ("2024-01-01", 1)
    one, two, three, four = ingested(spark, tmp_path, [
        [(path.format("a"), 900, 1)], [(path.format("a"), 300, 2), (path.format("b"), 950, 1)], [(path.format("a"), 990, 1)],
        [(path.format("c"), 310, 2)]])
    assert [t[key].size_mb for t in (one, two, three, four)] == [900, 300, 300, 310]


def test_only_touched_partitions_are_read(spark, tmp_path):
    schema = "recording_date string, case_no int, size_mb int"
    rows = spark.createDataFrame([(f"2024-01-{d:02d}", 1, d) for d in range(1, 29)], schema)
    overwrite_partitions(rows, str(tmp_path / "p"))
    table = spark.read.schema(schema).parquet(str(tmp_path / "p"))
    some = touched_partitions(table, rows.filter("size_mb in (3, 5)"))
    assert some.count() == 2
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [recording_date" in plan and "2024-01-03" in plan


def test_stalls_and_bursts_take_rows_with_gaps_in_any_time_zone(spark, tmp_path):
    """Rows without a frame or a time are passed over; alerts tell the moment whatever the session's zone."""
    rows = [("a", 10, 0), ("a", None, 5), ("a", 20, None), ("a", 30, 3 * 3600), ("a", 40, 3 * 3600 + 1), ("clock", 1, 9 * 86400)]
    df = spark.createDataFrame(rows, "job string, frame bigint, at bigint").select("job", "frame", F.timestamp_seconds(F.col("at") + 86400).alias("ts"))
    frames = df.select(F.col("job").alias("video"), "frame", F.lit(True).alias("good"), F.lit(True).alias("usable"), "ts")
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        stream = replay(spark, df, tmp_path, "gaps", [F.lit(True)])
        alerts = drain(stall_alerts(stream), tmp_path, "gap_alerts").filter("job = 'a'")
        got = sorted(alerts.select("frame", F.unix_seconds("stalled_since") - 86400).collect())
        bursts = drain(capture_bursts_stream(replay(spark, frames, tmp_path, "gap_frames", [F.lit(True)]), gap=9), tmp_path, "gap_bursts")
        found = bursts.filter("video = 'a'").select("start_frame", "saved", "outcome").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert list(map(tuple, got)) == [(10, 0), (40, 3 * 3600 + 1)]
    assert list(map(tuple, found)) == [(10, [10, 20, 30], "complete")]


class Calls:
    """A state handle that notes the calls, each a round trip to the JVM."""

    def __init__(self):
        self.made, self.value = [], None

    def __getattr__(self, name):
        def call(*args):
            self.made.append(name)
            return [] if name == "listTimers" else self if name == "getValueState" else self.value

        return call

    def update(self, value):
        self.made.append("update")
        self.value = value


def test_a_new_key_costs_few_calls_and_one_row():
    at = [T0.replace(tzinfo=dt.timezone.utc) + dt.timedelta(hours=k) for k in range(0, 8, 2)]
    stalls, bursts = _StallKeeper(3_600_000, 86_400_000), _BurstKeeper(3, 0, 5, 60_000)
    frames = [Row(video="v", frame=k, good=True, usable=True, ts=t) for k, t in enumerate(at)]
    progress = [Row(job="v", frame=k, ts=t) for k, t in enumerate(at)]
    for keeper, rows in ((stalls, progress), (bursts, frames)):
        calls = Calls()
        keeper.init(calls)
        out = list(keeper.handleInputRows(("v",), iter(rows), None))
        assert len(out) == 1 and sorted(calls.made) == ["get", "getValueState", "registerTimer", "update"]
        assert list(keeper.handleInputRows(("v",), iter(rows[:1]), None)) == []
