"""Binary container headers and frame indexes, read with bounded seeks inside tasks.

The input is a listing (path, length). Large index files are cut into record ranges before they are
spread over the cluster, so one long recording does not become one long task.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from reelspark.plans.spread import spread
from reelspark.sources.remote import open_file, read_range

# Container layout.
HEADER_BYTES = 1024
MAGIC = 0x0000FEED
DESCRIPTION_AT, DESCRIPTION_BYTES = 36, 512
WIDTH_AT, HEIGHT_AT, ALLOCATED_AT = 548, 552, 572
FPS_AT, COMPRESSION_AT, RECORDED_AT, EXPOSURE_AT = 584, 620, 624, 636
FRAME_GAP_BYTES = 8

# Layout of one 32-byte little-endian index record.
RECORD = np.dtype([
    ("offset", "<u8"), ("size", "<u4"), ("ts_seconds", "<u4"), ("ts_sub", "<u4"),
    ("reserved", "<u4"), ("flags", "<u4"), ("frame_number", "<u4"),
])

HEADER_SCHEMA = (
    "path string, header_ok boolean, description string, width bigint, height bigint, "
    "allocated_frames bigint, fps double, compression_fmt bigint, rec_timestamp bigint, exposure_ns bigint"
)
FRAME_SCHEMA = (
    "file string, rec_no bigint, offset bigint, size bigint, ts_seconds bigint, ts_sub bigint, "
    "flags bigint, frame_number bigint"
)
_FRAME_ARROW = pa.schema([("file", pa.string())] + [
    (n, pa.int64())
    for n in ("rec_no", "offset", "size", "ts_seconds", "ts_sub", "flags", "frame_number")
])
RANGE_RECORDS = 1 << 18
BATCH_RECORDS = 1 << 16


def header_row(path: str, raw: bytes) -> dict:
    """Fields of a container's first HEADER_BYTES."""
    row: dict = {"path": path, "header_ok": False}
    if len(raw) < HEADER_BYTES or struct.unpack_from("<I", raw, 0)[0] != MAGIC:
        return row
    text = raw[DESCRIPTION_AT:DESCRIPTION_AT + DESCRIPTION_BYTES].decode("utf-16-le", errors="replace")
    u32 = {
        "width": WIDTH_AT, "height": HEIGHT_AT, "allocated_frames": ALLOCATED_AT,
        "compression_fmt": COMPRESSION_AT, "rec_timestamp": RECORDED_AT, "exposure_ns": EXPOSURE_AT,
    }
    row.update({name: struct.unpack_from("<I", raw, at)[0] for name, at in u32.items()})
    row.update(
        header_ok=True,
        description=text.split("\x00")[0],
        fps=round(struct.unpack_from("<d", raw, FPS_AT)[0], 6),
    )
    return row


def scan_seq_headers(files: DataFrame) -> DataFrame:
    """Header fields per path. Short, unreadable or foreign files have header_ok false and NULL fields."""
    target = pa.schema([
        ("path", pa.string()), ("header_ok", pa.bool_()), ("description", pa.string()),
        ("width", pa.int64()), ("height", pa.int64()), ("allocated_frames", pa.int64()), ("fps", pa.float64()),
        ("compression_fmt", pa.int64()), ("rec_timestamp", pa.int64()), ("exposure_ns", pa.int64()),
    ])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [header_row(p, read_range(p, 0, HEADER_BYTES)) for p in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_pylist(rows, schema=target)

    return spread(files.select("path"), "path").mapInArrow(read, HEADER_SCHEMA)


def frame_batch(path: str, first: int, records: np.ndarray) -> pa.RecordBatch:
    columns = {n: records[n].astype(np.int64) for n in RECORD.names if n != "reserved"}
    columns["rec_no"] = np.arange(first, first + len(records), dtype=np.int64)
    columns["file"] = pa.array([path] * len(records), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name]) for f in _FRAME_ARROW], schema=_FRAME_ARROW)


def scan_frame_index(files: DataFrame, drop_empty: bool = False, range_records: int = RANGE_RECORDS) -> DataFrame:
    """All records of index files; a trailing partial record is ignored, counters are unsigned."""
    records = F.floor(F.col("length") / RECORD.itemsize)
    ranges = spread(
        files.select("path", records.alias("records"))
        .filter("records > 0")
        .select("path", "records", F.explode(F.expr(f"sequence(0L, records - 1, {range_records}L)")).alias("first"))
        .withColumn("count", F.least(F.lit(range_records).cast("long"), F.col("records") - F.col("first")))
        .select("path", "first", "count"),
        "path", "first",
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                for at in range(r["first"], r["first"] + r["count"], BATCH_RECORDS):
                    n = min(BATCH_RECORDS, r["first"] + r["count"] - at)
                    raw = read_range(r["path"], at * RECORD.itemsize, n * RECORD.itemsize)
                    whole = len(raw) // RECORD.itemsize
                    if whole:
                        yield frame_batch(r["path"], at, np.frombuffer(raw, RECORD, count=whole))

    frames = ranges.mapInArrow(read, FRAME_SCHEMA)
    return frames.filter("size > 0") if drop_empty else frames


def seconds(record: np.ndarray) -> float:
    """Capture time of a record."""
    sub = int(record["ts_sub"])
    return float(record["ts_seconds"]) + (sub & 0xFFFF) / 1e3 + ((sub >> 16) & 0xFFFF) / 1e6


def scan_index_endpoints(files: DataFrame) -> DataFrame:
    """Frame count and first/last capture time from two small reads per index file.

    Files below one record, or with an empty first record, give NULLs."""
    schema = pa.schema([
        ("path", pa.string()), ("frame_count", pa.int64()), ("t_start", pa.float64()), ("t_end", pa.float64()),
        ("idx_file_size", pa.int64()),
    ])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                n = r["length"] // RECORD.itemsize
                row = {"path": r["path"]}
                if n:
                    first = np.frombuffer(read_range(r["path"], 0, RECORD.itemsize), RECORD)
                    last = np.frombuffer(read_range(r["path"], (n - 1) * RECORD.itemsize, RECORD.itemsize), RECORD)
                    if len(first) and len(last) and int(first[0]["size"]) > 0:
                        row.update(frame_count=n, t_start=seconds(first[0]), t_end=seconds(last[0]),
                                   idx_file_size=r["length"])
                rows.append(row)
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    listing = spread(files.select("path", F.col("length").cast("long").alias("length")), "path")
    return listing.mapInArrow(
        read, "path string, frame_count bigint, t_start double, t_end double, idx_file_size bigint"
    )


def _walk(path: str) -> Iterator[tuple]:
    """Frame blocks of a container: 8-byte prefix (size, fps, low counter word), payload, 8-byte time."""
    with open_file(path) as f:
        end = f.size()
        at, n, wraps, previous = HEADER_BYTES, 0, 0, 0
        while at + 8 <= end:
            f.seek(at)
            size, _fps, low = struct.unpack("<IHH", f.read(8))
            if size == 0:
                return
            f.seek(at + size)
            stamp = f.read(FRAME_GAP_BYTES)
            if len(stamp) < FRAME_GAP_BYTES:
                return
            sec, ms, us = struct.unpack("<IHH", stamp)
            if previous - low > 0x8000:
                wraps += 1
            previous = low
            yield n, at, size, sec, us << 16 | ms, 0, wraps << 16 | low
            at += size + FRAME_GAP_BYTES
            n += 1


def rebuild_frame_index(files: DataFrame) -> DataFrame:
    """Frame index of containers that lost theirs, in the schema of `scan_frame_index`.

    Each block names the position of the next, so a file is one task; only 16 bytes per frame are read."""

    def flush(path: str, rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows))
        arrays = [pa.array([path] * len(rows), pa.string())] + [pa.array(c, pa.int64()) for c in columns]
        return pa.RecordBatch.from_arrays(arrays, schema=_FRAME_ARROW)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows: list[tuple] = []
                try:
                    for row in _walk(path):
                        rows.append(row)
                        if len(rows) == BATCH_RECORDS:
                            yield flush(path, rows)
                            rows = []
                except OSError:
                    pass
                if rows:
                    yield flush(path, rows)

    return spread(files.select("path"), "path").mapInArrow(read, FRAME_SCHEMA)
