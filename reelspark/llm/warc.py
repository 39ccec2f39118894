"""WARC archives of pages with a two-level capture index."""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import struct
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from reelspark.llm.common import query, shared_dir, table, written

#: Captures in a compressed block of the index.
BLOCK = 300
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Pages carry no time; every capture has this one.
DATE = "2000-01-01T00:00:00Z"
CAPTURE = pa.schema([
    ("key", pa.string()), ("page_id", pa.int64()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()),
    ("type", pa.string())])
RECORD = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])


def _ddl(schema: pa.Schema) -> str:
    names = {pa.string(): "string", pa.int64(): "bigint", pa.binary(): "binary"}
    return ", ".join(f"`{f.name}` {names[f.type]}" for f in schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def url_key(url: str | None) -> str:
    """Sort key of a URL: host parts reversed, then path and query, in lower case: `com,example,www)/a?b`."""
    try:
        parts = urlsplit((url or "").strip())
        host = ",".join(reversed((parts.hostname or "").split(".")))
        port = f":{parts.port}" if parts.port else ""
    except ValueError:  # not a URL; it sorts as it is written
        return re.sub(r"[\x00-\x20]", "", url or "").lower()
    path = f"{parts.path or '/'}{'?' + parts.query if parts.query else ''}"
    return re.sub(r"[\x00-\x20]", "", f"{host}{port}){path}".lower())


def _header(value: str | None) -> str:
    """A header value on one line."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value or "")


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One gzip member: a response with its payload, or a revisit with the HTTP head alone."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    body = http if refers_to is not None else http + payload
    lines = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Target-URI: {_header(url)}",
        f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response",
    ]
    if refers_to is not None:
        lines += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines.append(f"Content-Length: {len(body)}")
    head = "\r\n".join(lines).encode("utf-8", "surrogatepass")
    return gzip.compress(head + b"\r\n\r\n" + body + b"\r\n\r\n", 6, mtime=0)


def parse(member: bytes) -> tuple:
    """A record's RECORD row; the digest of a response is of the payload as read, and must be the one it states."""
    head, _, rest = gzip.decompress(member).partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    http, _, payload = rest[:int(fields["Content-Length"])].partition(b"\r\n\r\n")
    stated = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])

    def page(name: str) -> int | None:
        number = fields[name].removeprefix("<urn:page:").removesuffix(">")
        return int(number) if number else None

    if fields["WARC-Type"] == "revisit":
        return page("WARC-Record-ID"), fields["WARC-Target-URI"], "revisit", page("WARC-Refers-To"), size, stated, None
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    if digest != stated or size != len(payload):
        raise ValueError(f"record of {fields['WARC-Record-ID']} is damaged")
    return page("WARC-Record-ID"), fields["WARC-Target-URI"], "response", None, size, digest, payload


def _write(path: str, parts: Iterator[bytes]) -> None:
    """A file that is there whole or not at all; another attempt of the task puts the same in its place."""
    store, place = fs.FileSystem.from_uri(path)
    store.create_dir(place.rsplit("/", 1)[0])
    context = TaskContext.get()
    temporary = f"{place}.{context.taskAttemptId() if context else 0}.part"
    with store.open_output_stream(temporary, compression=None) as f:
        for part in parts:
            f.write(part)
    store.move(temporary, place)


def revisits(pages: DataFrame, least: int = 0) -> DataFrame:
    """Distinct (page_id, sha1, refers_to) of pages whose payload, of `least` bytes or more, a smaller page_id has too.

    Payloads are counted before pages meet them, so a common payload is no large group."""
    narrow = pages.select("page_id", F.sha1("payload").alias("sha1"), F.length("payload").alias("n"))
    firsts = narrow.filter(F.col("n") >= least).groupBy("sha1").agg(
        F.min("page_id").alias("refers_to"), F.count("*").alias("copies")).filter("copies > 1").drop("copies")
    return narrow.join(firsts, "sha1").filter("page_id <> refers_to").select("page_id", "sha1", "refers_to").distinct()


def write_archives(pages: DataFrame, path: str, least: int = 0) -> DataFrame:
    """Write a record for each row of `pages` (page_id, url, html) below `path`, a file a task, and return the captures.

    Of pages with equal payloads of at least `least` bytes, that with the smallest page_id is a response and the others
    revisit it. Null html is an empty payload; null urls are empty; a null page_id is always a response; repeated rows
    get a record each. Other columns are left out."""
    pages = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    keyed = pages.withColumn("sha1", F.sha1("payload"))
    rows = keyed.join(revisits(pages, least), ["page_id", "sha1"], "left").sortWithinPartitions("page_id", "sha1", "url")

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = f"{path}/archive/{TaskContext.get().partitionId():06d}.warc.gz"
        captures: list[tuple] = []

        def members() -> Iterator[bytes]:
            at = 0
            for batch in batches:
                for k in range(batch.num_rows):
                    page_id, sha1, url, payload, refers_to = (c[k].as_py() for c in batch.columns)
                    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                    member = record(page_id, url, payload, digest, refers_to)
                    kind = "response" if refers_to is None else "revisit"
                    captures.append((url_key(url), page_id, file, at, len(member), kind))
                    at += len(member)
                    yield member

        first = next(batches, None)
        if first is None:
            return
        rest = batches
        batches = (b for some in ([first], rest) for b in some)
        _write(file, members())
        for k in range(0, len(captures), 5000):
            yield _batch(captures[k:k + 5000], CAPTURE)

    columns = ["page_id", "sha1", "url", "payload", "refers_to"]
    return written(rows.select(*columns).mapInArrow(archive, _ddl(CAPTURE)))


def write_index(captures: DataFrame, path: str, files: int | None = None) -> DataFrame:
    """Sort the captures by key into index files below `path` and return their manifest: file, first_key, last_key, n.

    A file is a run of compressed blocks of BLOCK captures, then a directory with each block's first key, place and
    length, and the directory's length in the last 8 bytes."""
    keys = ["key", "page_id", "file", "offset"]
    ranged = captures.repartitionByRange(files, *keys) if files else captures.repartitionByRange(*keys)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = f"{path}/index/{TaskContext.get().partitionId():06d}.cdx"
        ends: list[str] = []
        count = [0]

        def parts() -> Iterator[bytes]:
            directory, at, rows = [], 0, []

            def block() -> bytes:
                data = zlib.compress("\n".join(map(json.dumps, rows)).encode())
                directory.append((rows[0][0], at, len(data)))
                ends[1:] = [rows[-1][0]]
                count[0] += len(rows)
                rows.clear()
                return data

            for batch in batches:
                for row in zip(*(c.to_pylist() for c in batch.columns)):
                    if not ends:
                        ends.append(row[0])
                    rows.append(row)
                    if len(rows) == BLOCK:
                        data = block()
                        yield data
                        at += len(data)
            if rows:
                yield block()
            footer = zlib.compress(json.dumps(directory).encode())
            yield footer + struct.pack("<Q", len(footer))

        first = next(batches, None)
        if first is None:
            return
        rest = batches
        batches = (b for some in ([first], rest) for b in some)
        _write(file, parts())
        yield pa.RecordBatch.from_pydict(
            {"file": [file], "first_key": ends[:1], "last_key": ends[-1:], "n": count})

    return written(ranged.sortWithinPartitions(*keys).mapInArrow(
        index, "file string, first_key string, last_key string, n bigint"))


class IndexFile:
    """One index file: its directory is read once, its blocks by range."""

    def __init__(self, path: str):
        store, place = fs.FileSystem.from_uri(path)
        self.file = store.open_input_file(place)
        size = self.file.size()
        length, = struct.unpack("<Q", self.file.read_at(8, size - 8))
        self.directory = json.loads(zlib.decompress(self.file.read_at(length, size - 8 - length)))
        self.first_keys = [d[0] for d in self.directory]
        self.unpacked, self.rows = -1, []

    def block(self, k: int) -> list[list]:
        """Captures of a block; the last one read stays unpacked, so keys in order unpack each block once."""
        if k != self.unpacked:
            _, at, length = self.directory[k]
            self.rows = [json.loads(line) for line in zlib.decompress(self.file.read_at(length, at)).decode().split("\n")]
            self.unpacked = k
        return self.rows

    def find(self, key: str) -> Iterator[list[list]]:
        """Captures of a key, a block at a time: the blocks that can hold it by binary search, and the key in them likewise."""
        for k in range(max(0, bisect_left(self.first_keys, key) - 1), bisect_right(self.first_keys, key)):
            rows = self.block(k)
            yield rows[bisect_left(rows, key, key=lambda r: r[0]):bisect_right(rows, key, key=lambda r: r[0])]


def read_index(manifest: DataFrame) -> DataFrame:
    """All captures of an index, in its files' order."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch["file"].to_pylist():
                file = IndexFile(path)
                for k in range(len(file.directory)):
                    yield _batch(file.block(k), CAPTURE)

    files = manifest.select("file").repartition(max(1, manifest.count()), "file")
    return files.mapInArrow(scan, _ddl(CAPTURE))


def lookup(urls: DataFrame, manifest: DataFrame) -> DataFrame:
    """Captures of the urls of `urls` (url), each once: binary search among the index files' first keys, in the directory
    of each file that can hold the key, and in its block.

    Null urls have the key of empty ones; urls that share a key find its captures once; repeated urls count once; no url or
    no index gives no rows. Keys are made distinct before they meet files, and each file is searched on its own in key
    order, so a key with very many captures is as many searches as it has index files. The manifest, a row for each index
    file (so at most one for each task that wrote the index), is the only thing that passes through the driver."""
    files = sorted((r["first_key"], r["last_key"], r["file"]) for r in manifest.collect())
    firsts = [f[0] for f in files]

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"key": sorted({url_key(u) for u in batch["url"].to_pylist()})})

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for key in batch["key"].to_pylist():
                k = bisect_right(firsts, key) - 1
                while k >= 0 and files[k][1] >= key:
                    found.append({"file": files[k][2], "key": key})
                    k -= 1
            if found:
                yield pa.RecordBatch.from_pylist(found)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, file, rows = None, None, []
        for batch in batches:
            for name, key in zip(batch["file"].to_pylist(), batch["key"].to_pylist()):
                if name != path:
                    path, file = name, IndexFile(name)
                for found in file.find(key):
                    rows += found
                    if len(rows) >= BLOCK:
                        yield _batch(rows, CAPTURE)
                        rows = []
        if rows:
            yield _batch(rows, CAPTURE)

    wanted = urls.select("url").mapInArrow(keys, "key string").distinct().mapInArrow(places, "file string, key string")
    return wanted.repartition(max(1, len(files)), "file").sortWithinPartitions("file", "key").mapInArrow(search, _ddl(CAPTURE))


def read_records(captures: DataFrame) -> DataFrame:
    """The records at the captures' places, read by range: page_id, url, record_type, refers_to, payload_bytes,
    payload_digest, payload (null for a revisit)."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, file = None, None
        for batch in batches:
            rows, size = [], 0
            for name, at, length in zip(*(batch[c].to_pylist() for c in ("file", "offset", "length"))):
                if name != path:
                    store, place = fs.FileSystem.from_uri(name)
                    path, file = name, store.open_input_file(place)
                rows.append(parse(file.read_at(length, at)))
                size += rows[-1][4]
                if size > 1 << 22:
                    yield _batch(rows, RECORD)
                    rows, size = [], 0
            if rows:
                yield _batch(rows, RECORD)

    # each archive is read by one task, front to back
    ordered = captures.repartition("file").sortWithinPartitions("file", "offset")
    return ordered.mapInArrow(read, _ddl(RECORD))


def archive_pages(pages: DataFrame, path: str | None = None, least: int = 0) -> DataFrame:
    """Archive `pages` below `path` (a new shared folder by default), index the archives, and return their records: the
    pages' urls are looked up in the index, and what it names is read by range. An empty table gives no files and no records."""
    path = path or shared_dir(pages.sparkSession)
    return read_records(lookup(pages, write_index(write_archives(pages, path, least), path)))


OP5_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS n, upper(sha1(coalesce(html, ''))) AS h FROM pages),
d AS (
  SELECT page_id, n, h, min(page_id) OVER (PARTITION BY h) AS first,
    array_to_string(list_transform(generate_series(0, 31), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((
      (CAST(strpos('0123456789ABCDEF', substr(h, 1 + (i * 5) // 4, 1)) - 1 AS INT) * 16
        + CASE WHEN (i * 5) // 4 < 39 THEN CAST(strpos('0123456789ABCDEF', substr(h, 2 + (i * 5) // 4, 1)) - 1 AS INT) ELSE 0 END)
      >> CAST(3 - (i * 5) % 4 AS INT)) & 31 AS INT), 1)), '') AS digest
  FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM d
"""


@query("op5_warc", OP5_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
