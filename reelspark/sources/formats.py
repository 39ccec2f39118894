"""Data sources for container headers and frame indexes: `spark.read.format(...)` over a directory.

Planning lists the directory once and cuts its files into partitions: headers and end points by number of files, records by
byte range. The option `pathGlob` names the files to plan for. With the option `pushFilters` filters on the path, and on the
record number, reach planning as well, so that what they exclude is never opened. The filters stay with Spark all the same.
Spark 4.1 keeps the plan of the first query with a loaded DataFrame, pushed filters included, so with pushed filters each
query needs a load() of its own; they are off unless asked for."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence
from fnmatch import fnmatchcase
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan,
    LessThanOrEqual, StringContains, StringEndsWith, StringStartsWith,
)

from reelspark.sources.containers import (
    BATCH_RECORDS, FRAME_SCHEMA, HEADER_BYTES, HEADER_SCHEMA, RANGE_RECORDS, RECORD, frame_batch, header_row, seconds,
)
from reelspark.sources.remote import open_file, open_filesystem

FILES = 100
ENDPOINT_SCHEMA = "path string, frame_count bigint, t_start double, t_end double, idx_file_size bigint"


@dataclass
class Part(InputPartition):
    """What one task reads: (path, length, first record, records) of each file or range; ranges of a file are neighbours."""

    pieces: tuple[tuple[str, int, int, int], ...]


def _matches(filters: Sequence[Filter], column: str, value: str) -> bool:
    """False where a filter on the column excludes the value; filters of other kinds exclude nothing."""
    for f in filters:
        if getattr(f, "attribute", None) != (column,):
            continue
        kept = True
        if isinstance(f, EqualTo):
            kept = value == f.value
        elif isinstance(f, In):
            kept = value in f.value
        elif isinstance(f, StringStartsWith):
            kept = value.startswith(f.value)
        elif isinstance(f, StringEndsWith):
            kept = value.endswith(f.value)
        elif isinstance(f, StringContains):
            kept = f.value in value
        if not kept:
            return False
    return True


def _bounds(filters: Sequence[Filter], column: str) -> tuple[float, float]:
    """Lowest and highest whole number that the filters on a column let through."""
    low, high = -math.inf, math.inf
    for f in filters:
        if getattr(f, "attribute", None) != (column,):
            continue
        if isinstance(f, EqualTo):
            low, high = max(low, f.value), min(high, f.value)
        elif isinstance(f, GreaterThan):
            low = max(low, f.value + 1)
        elif isinstance(f, GreaterThanOrEqual):
            low = max(low, f.value)
        elif isinstance(f, LessThan):
            high = min(high, f.value - 1)
        elif isinstance(f, LessThanOrEqual):
            high = min(high, f.value)
    return low, high


class _DirectoryReader(DataSourceReader):
    """Lists the directory and packs what the filters leave."""

    column = "path"

    def __init__(self, options: dict, suffix: str):
        if not options.get("path"):
            raise ValueError("load() needs a directory")
        self.root = options["path"]
        self.suffix = options.get("extension", suffix).lower()
        self.glob = options.get("pathGlob", "*")
        self.files = max(1, int(options.get("filesPerPartition", FILES)))
        self.filters: list[Filter] = []

    def listing(self) -> list[tuple[str, int]]:
        system, inner = open_filesystem(self.root)
        prefix = self.root[: len(self.root) - len(inner)] if self.root.endswith(inner) else ""
        try:
            found = system.get_file_info(pafs.FileSelector(inner, recursive=True))
        except OSError:
            return []
        files = ((prefix + i.path, i.size) for i in found if i.type == pafs.FileType.File)
        return sorted(
            f for f in files if f[0].lower().endswith(self.suffix) and fnmatchcase(f[0], self.glob)
            and _matches(self.filters, self.column, f[0]))

    def partitions(self) -> Sequence[InputPartition]:
        files = [(path, size, 0, 0) for path, size in self.listing()]
        return [Part(tuple(files[k:k + self.files])) for k in range(0, len(files), self.files)] or [Part(())]


class _Headers(_DirectoryReader):
    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        rows = []
        for path, *_ in partition.pieces:
            try:
                with open_file(path) as f:
                    raw = f.read(HEADER_BYTES)
            except OSError:
                raw = b""
            rows.append(header_row(path, raw))
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=_HEADER_ARROW)


class _Endpoints(_DirectoryReader):
    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        rows = []
        for path, size, *_ in partition.pieces:
            row: dict = {"path": path}
            n = size // RECORD.itemsize
            if n:
                try:
                    with open_file(path) as f:
                        first = np.frombuffer(f.read(RECORD.itemsize), RECORD)
                        f.seek((n - 1) * RECORD.itemsize)
                        last = np.frombuffer(f.read(RECORD.itemsize), RECORD)
                except OSError:
                    first = last = np.zeros(0, RECORD)
                if len(first) and len(last) and int(first[0]["size"]) > 0:
                    row.update(frame_count=n, t_start=seconds(first[0]), t_end=seconds(last[0]), idx_file_size=size)
            rows.append(row)
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=_ENDPOINT_ARROW)


class _Frames(_DirectoryReader):
    column = "file"

    def __init__(self, options: dict, suffix: str):
        super().__init__(options, suffix)
        self.range = max(1, int(options.get("rangeRecords", RANGE_RECORDS)))

    def partitions(self) -> Sequence[InputPartition]:
        """Record ranges; short files share a partition, up to one range's records."""
        low, high = _bounds(self.filters, "rec_no")
        parts: list[list] = [[]]
        held = 0
        for path, size in self.listing():
            first, end = int(max(low, 0)), int(min(high + 1, size // RECORD.itemsize))
            for at in range(first, end, self.range):
                n = min(self.range, end - at)
                if held + n > self.range or len(parts[-1]) == self.files:
                    parts.append([])
                    held = 0
                parts[-1].append((path, size, at, n))
                held += n
        return [Part(tuple(p)) for p in parts if p] or [Part(())]

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        for path, _, first, count in partition.pieces:
            try:
                with open_file(path) as f:
                    f.seek(first * RECORD.itemsize)
                    for at in range(first, first + count, BATCH_RECORDS):
                        raw = f.read(min(BATCH_RECORDS, first + count - at) * RECORD.itemsize)
                        whole = len(raw) // RECORD.itemsize
                        if whole:
                            yield frame_batch(path, at, np.frombuffer(raw, RECORD, count=whole))
            except OSError:
                continue


class _Pushing(DataSourceReader):
    """Lets filters into planning; all of them are returned, so Spark applies them as well."""

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        self.filters = list(filters)
        return self.filters


class _PushedHeaders(_Pushing, _Headers):
    pass


class _PushedEndpoints(_Pushing, _Endpoints):
    pass


class _PushedFrames(_Pushing, _Frames):
    pass


def _pushed(options: dict) -> bool:
    return str(options.get("pushFilters", "false")).lower() == "true"


_HEADER_ARROW = pa.schema([
    ("path", pa.string()), ("header_ok", pa.bool_()), ("description", pa.string()), ("width", pa.int64()),
    ("height", pa.int64()), ("allocated_frames", pa.int64()), ("fps", pa.float64()), ("compression_fmt", pa.int64()),
    ("rec_timestamp", pa.int64()), ("exposure_ns", pa.int64()),
])
_ENDPOINT_ARROW = pa.schema([
    ("path", pa.string()), ("frame_count", pa.int64()), ("t_start", pa.float64()), ("t_end", pa.float64()),
    ("idx_file_size", pa.int64()),
])


class SeqHeaders(DataSource):
    """Header fields of all containers below a directory; as `scan_seq_headers`."""

    @classmethod
    def name(cls) -> str:
        return "seq_headers"

    def schema(self) -> str:
        return HEADER_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return (_PushedHeaders if _pushed(self.options) else _Headers)(self.options, ".seq")


class FrameIndex(DataSource):
    """All records of the index files below a directory; as `scan_frame_index`."""

    @classmethod
    def name(cls) -> str:
        return "frame_index"

    def schema(self) -> str:
        return FRAME_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return (_PushedFrames if _pushed(self.options) else _Frames)(self.options, ".idx")


class IndexEndpoints(DataSource):
    """Frame count and end points of the index files below a directory; as `scan_index_endpoints`."""

    @classmethod
    def name(cls) -> str:
        return "index_endpoints"

    def schema(self) -> str:
        return ENDPOINT_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return (_PushedEndpoints if _pushed(self.options) else _Endpoints)(self.options, ".idx")


def register(spark: SparkSession) -> None:
    """Make the formats known to a session. The setting only allows readers that ask for filters to get them."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    for source in (SeqHeaders, FrameIndex, IndexEndpoints):
        spark.dataSource.register(source)
