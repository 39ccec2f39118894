"""Continuous twins of the batch operators, on Structured Streaming.

Keyed state lives in the RocksDB store (set `spark.sql.streaming.stateStore.providerClass` to STATE_STORE) and
holds a few numbers per key. Rows later than the watermark are dropped by Spark."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Iterator
from operator import itemgetter

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from reelspark.constants import RECORDING_KEY
from reelspark.functions import sync_status
from reelspark.operators.assets import largest_file, parse_recording_key, reuse_cached
from reelspark.operators.catalog import classify_changes, overwrite_partitions, touched_partitions, upsert_managed
from reelspark.operators.keys import one_per_key

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
MANAGED = ("size_mb", "path", "status", "scan_version")
METRIC = "duration_minutes"
STATUS_SCHEMA = (
    "recording_date string, case_no int, camera_name string, size_mb bigint, path string, status int, scan_version bigint, "
    f"{METRIC} double, needs_compute boolean"
)


def sync_monitor(
    ticks: DataFrame, lateness: str = "2 seconds", every: str = "100 milliseconds", tolerance: float = 0.3
) -> DataFrame:
    """Sync status of every camera per poll tick, against the reference camera of its case.

    One stateful aggregation: a tick holds at most a few readings per camera of one case. A camera that is
    not alive reports error/Exited; without a reference position the status is NULL."""
    reading = F.struct("ts", "camera_name", "position", "offset_seconds", "is_reference", "alive")
    grouped = (
        ticks.withWatermark("ts", lateness)
        .groupBy("recording_date", "case_no", F.window("ts", every).alias("tick"))
        .agg(F.array_sort(F.collect_list(reading)).alias("_all"))
    )
    latest = F.filter("_all", lambda r, i: ~F.exists(
        F.slice(F.col("_all"), i + 2, F.size("_all")), lambda later: later["camera_name"] == r["camera_name"]))
    rows = grouped.withColumn("_now", latest).withColumn(
        "_ref", F.try_element_at(F.filter("_now", lambda r: r["is_reference"]), F.lit(-1))["position"]
    ).select("recording_date", "case_no", F.col("tick.start").alias("tick"), "_ref", F.inline("_now"))
    return rows.withColumn("_s", sync_status("position", "_ref", "offset_seconds", tolerance)).select(
        "recording_date", "case_no", "tick", "camera_name", "position", F.col("_ref").alias("reference"),
        F.when(F.col("alive"), F.col("_s.delta")).alias("delta"),
        F.when(F.col("alive"), F.col("_s.status")).otherwise("error").alias("status"),
        F.when(F.col("alive"), F.col("_s.text")).otherwise("Exited").alias("text"),
    )


def _millis(ts: pd.Timestamp) -> int:
    return int(ts.timestamp() * 1000)


def _rearm(handle, at: int) -> None:
    """The key's one timer."""
    for timer in handle.listTimers():
        handle.deleteTimer(timer)
    handle.registerTimer(at)


def _batches(rows: Iterator[pd.DataFrame], order: str) -> pd.DataFrame:
    frames = list(rows)
    return pd.concat(frames).sort_values(order, kind="stable") if frames else pd.DataFrame()


def _ordered(rows: Iterable[Row], place: int) -> list[tuple]:
    """A key's rows by the column at a place, those without it left out. As plain tuples: a Row looks its fields up slowly."""
    at = itemgetter(place)
    return sorted((r for r in map(tuple, rows) if at(r) is not None), key=at)


EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)


def _micros(ts: dt.datetime) -> int:
    return (ts - EPOCH) // dt.timedelta(microseconds=1)


class _DurationKeeper(StatefulProcessor):
    def __init__(self, idle_ms: int):
        self.idle_ms = idle_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.known = handle.getValueState("known", "duration double")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        state = self.known.get()
        current = state[0] if state else 0.0
        out, last = [], None
        for r in _batches(rows, "ts").itertuples():
            last = r.ts
            if r.duration and r.duration > 0 and abs(current - r.duration) > 1.0:
                current = float(r.duration)
                out.append((*key, r.ts, current))
        self.known.update((current,))
        if last is not None:
            _rearm(self.handle, _millis(last) + self.idle_ms)
        yield pd.DataFrame(out, columns=["recording_date", "case_no", "camera_name", "ts", "duration"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.known.clear()
        yield pd.DataFrame(columns=["recording_date", "case_no", "camera_name", "ts", "duration"])

    def close(self) -> None:
        pass


def duration_updates(ticks: DataFrame, idle_seconds: int = 3600, lateness: str = "1 minute") -> DataFrame:
    """Reported video durations, only when they move by more than a second. A camera that reports nothing for
    `idle_seconds` is forgotten."""
    return ticks.withWatermark("ts", lateness).groupBy(*RECORDING_KEY).transformWithStateInPandas(
        statefulProcessor=_DurationKeeper(idle_seconds * 1000),
        outputStructType="recording_date string, case_no int, camera_name string, ts timestamp, duration double",
        outputMode="Append", timeMode="EventTime",
    )


class _BurstKeeper(StatefulProcessor):
    """Scanning resumes at `resume`; while a burst is open, `check` is the next frame that must show a person."""

    burst = Row("video", "start_frame", "saved", "outcome")

    def __init__(self, size: int, gap: int, cooldown: int, idle_ms: int | None):
        self.size, self.gap, self.cooldown, self.idle_ms = size, gap, cooldown, idle_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.mode = handle.getValueState("mode", "resume bigint, check bigint, seen int, saved array<bigint>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        state = self.mode.get()
        resume, check, seen, saved = (state[0], state[1], state[2], list(state[3])) if state else (0, -1, 0, [])
        out = []

        def finish(outcome: str) -> None:
            nonlocal resume, check, seen, saved
            out.append(self.burst(key[0], saved[0], saved, outcome))
            resume, check, seen, saved = check + self.cooldown + 1, -1, 0, []

        rows = [tuple(r) for r in rows]
        last = None if self.idle_ms is None else max((r[4] for r in rows if r[4] is not None), default=None)
        for _, frame, good, usable, *_ in _ordered(rows, 1):
            if check >= 0 and (frame > check or (frame == check and not good)):
                finish("aborted")
            if check >= 0:
                if frame == check:
                    seen += 1
                    if usable:
                        saved.append(frame)
                    if seen == self.size:
                        finish("complete")
                    else:
                        check += self.gap + 1
            elif frame >= resume and good and usable:
                saved, seen, check = [frame], 1, frame + self.gap + 1
        self.mode.update((resume, check, seen, saved))
        if last is not None:
            if state:
                _rearm(self.handle, _micros(last) // 1000 + self.idle_ms)
            else:  # a key without state has no timer
                self.handle.registerTimer(_micros(last) // 1000 + self.idle_ms)
        yield from out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        """The video has ended: a burst that waits for its next frame stays open."""
        state = self.mode.get()
        if state and state[1] >= 0:
            yield self.burst(key[0], state[3][0], list(state[3]), "open")
        self.mode.clear()

    def close(self) -> None:
        pass


def capture_bursts_stream(
    frames: DataFrame, size: int = 3, gap: int = 20, cooldown: int = 300, idle_seconds: int = 600,
    lateness: str = "1 minute",
) -> DataFrame:
    """Bursts as they finish, from live frames (video, frame, good, usable, ts) in frame order per video.

    `good` means a confident person clear of the edges; frames without one are sent too, since losing the
    person is what aborts a burst. A video that sends nothing for `idle_seconds` of event time has ended: its open burst is
    written out and its state goes. Without a `ts` column nothing tells an end, so open bursts stay in the state."""
    timed = "ts" in frames.columns
    rows = frames.select("video", F.col("frame").cast("bigint"), "good", "usable", *(["ts"] if timed else []))
    source = rows.withWatermark("ts", lateness) if timed else rows
    return source.groupBy("video").transformWithState(
        statefulProcessor=_BurstKeeper(size, gap, cooldown, idle_seconds * 1000 if timed else None),
        outputStructType="video string, start_frame bigint, saved array<bigint>, outcome string",
        outputMode="Append", timeMode="EventTime" if timed else "None",
    )


class _StallKeeper(StatefulProcessor):
    """`alerted` tells whether the present standstill has been reported. A job's alerts of a batch leave as one row of arrays."""

    alerts = Row("job", "frames", "since_us")

    def __init__(self, timeout_ms: int, forget_ms: int):
        self.timeout_ms, self.forget_ms = timeout_ms, forget_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "frame bigint, at_us bigint, alerted boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        state = self.last.get()
        frame, at, alerted = state if state else (-1, None, False)
        frames, since, moved = [], [], False
        for _, reached, ts in _ordered(rows, 2):
            if reached is not None and reached > frame:
                now = _micros(ts)
                if at is not None and now - at > self.timeout_ms * 1000 and not alerted:  # a standstill within the batch
                    frames.append(frame)
                    since.append(at)
                frame, at, alerted, moved = reached, now, False, True
        if moved:
            if state:  # the timer set for what the state tells
                self.handle.deleteTimer(state[1] // 1000 + self.timeout_ms + (self.forget_ms if state[2] else 0))
            self.handle.registerTimer(at // 1000 + self.timeout_ms)
            self.last.update((frame, at, False))
        if frames:
            yield self.alerts(key[0], frames, since)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        state = self.last.get()
        if state and not state[2]:
            frame, at, _ = state
            yield self.alerts(key[0], [frame], [at])
            self.last.update((frame, at, True))
            self.handle.registerTimer(at // 1000 + self.timeout_ms + self.forget_ms)
        else:
            self.last.clear()

    def close(self) -> None:
        pass


def stall_alerts(
    progress: DataFrame, timeout_seconds: int = 3600, lateness: str = "1 minute", forget_seconds: int = 86400,
) -> DataFrame:
    """Standstills: jobs whose frame counter has not advanced for the timeout, from progress rows (job, frame, ts).

    A standstill is reported once, by a timer or by the rows that end it, so the alerts do not depend on how rows fall into
    batches. A job is forgotten `forget_seconds` after its alert."""
    rows = progress.select("job", F.col("frame").cast("bigint"), "ts")
    alerts = rows.withWatermark("ts", lateness).groupBy("job").transformWithState(
        statefulProcessor=_StallKeeper(timeout_seconds * 1000, forget_seconds * 1000),
        outputStructType="job string, frames array<bigint>, since_us array<bigint>",
        outputMode="Append", timeMode="EventTime",
    )
    return alerts.select("job", F.inline(F.arrays_zip("frames", "since_us")).alias("frame", "since_us")).select(
        "job", "frame", F.timestamp_micros("since_us").alias("stalled_since"))


class _PoseKeeper(StatefulProcessor):
    def __init__(self, max_age: int, fps: float):
        self.max_age, self.fps = max_age, fps

    def init(self, handle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "frame bigint, x double, y double")

    def _carried(self, key, pose, until: int) -> list[tuple]:
        frame, x, y = pose
        return [(*key, f, frame, x, y, f - frame) for f in range(frame, min(until, frame + self.max_age) + 1)]

    columns = ["video", "Track_ID", "frame", "pose_frame", "x", "y", "age"]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        state = self.last.get()
        pose = tuple(state) if state else None
        out, stamp = [], None
        for r in _batches(rows, "Frame_ID").itertuples():
            if pose is not None and r.Frame_ID > pose[0]:
                out += self._carried(key, pose, int(r.Frame_ID) - 1)
            pose, stamp = (int(r.Frame_ID), float(r.x), float(r.y)), r.ts
        if stamp is not None:
            self.last.update(pose)
            _rearm(self.handle, int(stamp.timestamp() * 1000 + self.max_age * 1000 / self.fps))
        yield pd.DataFrame(out, columns=self.columns)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        state = self.last.get()
        out = self._carried(key, tuple(state), state[0] + self.max_age) if state else []
        self.last.clear()
        yield pd.DataFrame(out, columns=self.columns)

    def close(self) -> None:
        pass


def live_pose(poses: DataFrame, max_age: int = 30, fps: float = 30.0, lateness: str = "1 second") -> DataFrame:
    """Poses carried to later frames until they are replaced or `max_age` frames old.

    A pose is written out when its successor arrives, or when event time passes its age limit."""
    return poses.withWatermark("ts", lateness).groupBy("video", "Track_ID").transformWithStateInPandas(
        statefulProcessor=_PoseKeeper(max_age, fps),
        outputStructType="video string, Track_ID bigint, frame bigint, pose_frame bigint, x double, y double, age bigint",
        outputMode="Append", timeMode="EventTime",
    )


def ingest_batch(table_path: str, change_log: str | None = None) -> Callable[[DataFrame, int], None]:
    """Micro-batch step: the largest file of each recording, change classes, managed upsert of the touched dates.

    A recording's stored row takes part in the choice, so a smaller file that comes later changes nothing. Files may carry a
    `scan_version`: a later scan replaces what an earlier one stored, whatever its size, and an earlier one changes nothing.
    The metric of a recording is kept while its size stays and marked for computing when it changes. Only partitions of the
    batch's dates are read and rewritten. Replaying a batch gives the same table; the change log is kept per batch id."""

    def step(files: DataFrame, batch_id: int) -> None:
        spark = files.sparkSession
        named = parse_recording_key(files).filter(F.col("recording_date").isNotNull())
        version = F.col("scan_version").cast("bigint") if "scan_version" in files.columns else F.lit(0).cast("bigint")
        named = named.withColumn("scan_version", version)
        last = named.groupBy(*RECORDING_KEY).agg(F.max("scan_version").alias("scan_version"))
        key = [*RECORDING_KEY, "scan_version"]
        scan = largest_file(named.join(last, key)).join(last, list(RECORDING_KEY))
        try:
            table = spark.read.schema(STATUS_SCHEMA).parquet(table_path)
        except AnalysisException:
            table = spark.createDataFrame([], STATUS_SCHEMA)
        current = touched_partitions(table, scan)
        best = one_per_key(
            scan.select(*RECORDING_KEY, *MANAGED, F.lit(0).alias("_stored")).unionByName(
                current.select(*RECORDING_KEY, *MANAGED, F.lit(1).alias("_stored"))),
            RECORDING_KEY, ["scan_version", "size_mb", "_stored"]).drop("_stored")
        changes = classify_changes(current, best.join(last.select(*RECORDING_KEY), list(RECORDING_KEY), "left_semi"), RECORDING_KEY, MANAGED)
        if change_log:
            changes.write.mode("overwrite").parquet(f"{change_log}/batch_id={batch_id}")
        updates = changes.filter("change <> 'UNCHANGED'").drop("change")
        rows = upsert_managed(current.drop(METRIC, "needs_compute"), updates, RECORDING_KEY, MANAGED)
        rows = reuse_cached(rows, current, RECORDING_KEY, "size_mb", METRIC)
        overwrite_partitions(rows.select(*table.columns), table_path)

    return step


def ingest_status(
    files: DataFrame, table_path: str, checkpoint: str, change_log: str | None = None, **trigger
) -> StreamingQuery:
    """Keep a recording status table up to date from a stream of (path, length) rows."""
    return (
        files.writeStream.foreachBatch(ingest_batch(table_path, change_log))
        .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
    )
