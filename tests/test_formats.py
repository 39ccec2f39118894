"""The formats give the rows of the scans over listings, and open only what filters leave."""

import pytest
from pyspark.sql import functions as F

from reelspark import sources as S
from reelspark.sources import formats
from test_sources import archive, header, record  # noqa: F401


@pytest.fixture
def registered(spark):
    formats.register(spark)
    return spark


def same(a, b):
    columns = sorted(a.columns)
    left, right = (sorted(map(tuple, df.select(columns).collect()), key=repr) for df in (a, b))
    assert left == right != []


def test_formats_equal_scans(registered, archive):  # noqa: F811
    spark, root = registered, str(archive)
    seq, idx = (S.scan_files(spark, root, e) for e in (".seq", ".idx"))
    same(spark.read.format("seq_headers").load(root), S.scan_seq_headers(seq))
    same(spark.read.format("index_endpoints").load(root), S.scan_index_endpoints(idx))
    for records in (7, 1 << 18):
        frames = spark.read.format("frame_index").option("rangeRecords", records).load(root)
        same(frames, S.scan_frame_index(idx, range_records=records))


def test_many_files_of_a_partition(registered, tmp_path):
    for k in range(30):
        (tmp_path / f"{k:02d}.seq").write_bytes(header(width=k + 1))
        (tmp_path / f"{k:02d}.idx").write_bytes(record(1024, 8, k, 0, 0, k) * (k + 1))
    read = registered.read.option("filesPerPartition", 8)
    headers = read.format("seq_headers").load(str(tmp_path))
    assert headers.rdd.getNumPartitions() == 4 and headers.agg(F.sum("width")).first()[0] == 465
    frames = read.format("frame_index").option("rangeRecords", 100).load(str(tmp_path))
    assert frames.count() == 465 and frames.rdd.getNumPartitions() == len(set(
        r[0] for r in frames.select(F.spark_partition_id()).distinct().collect()))


def opened(reader):
    return sorted({p[0] for part in reader.partitions() for p in part.pieces})


def test_filters_prune_partitions(registered, archive):  # noqa: F811
    """A filter on the path leaves other files unopened, one on the record number other ranges unread."""
    def load(name):
        return registered.read.format(name).options(rangeRecords=10, pushFilters=True).load(str(archive))

    one = load("frame_index").filter(F.col("file").endswith("a.123.SEQ.idx"))
    assert one.count() == 100 and one.rdd.getNumPartitions() == 10
    some = load("frame_index").filter(F.col("file").endswith("a.123.SEQ.idx") & (F.col("rec_no") >= 35) & (F.col("rec_no") < 52))
    assert sorted(r.rec_no for r in some.collect()) == list(range(35, 52)) and some.rdd.getNumPartitions() == 2
    path = load("seq_headers").filter("header_ok").first()["path"]
    assert load("seq_headers").filter(F.col("path") == path).count() == 1
    assert load("seq_headers").filter(F.col("path").isin(path, "nowhere")).select("width").first()["width"] == 2048
    assert load("seq_headers").filter(F.col("path").contains("short") | (F.col("width") > 0)).count() == 2


def test_one_load_for_many_queries(registered, archive):  # noqa: F811
    headers = registered.read.format("seq_headers").load(str(archive))
    assert headers.filter(F.col("path").contains("short")).count() == 1 and headers.count() == 3
    assert registered.read.format("seq_headers").option("pathGlob", "*/Monitor/s*").load(str(archive)).count() == 1


@pytest.mark.parametrize("filters, files", [
    ([], 4), ([("EqualTo", "{}/a.123.seq")], 1), ([("StringStartsWith", "/nowhere")], 0), ([("StringContains", "a.123")], 1),
])
def test_planning_opens_what_filters_leave(archive, filters, files):  # noqa: F811
    folder = archive / "DATA_22-12-04" / "Case1" / "Monitor"
    reader = formats._PushedHeaders({"path": str(archive)}, ".seq")
    (folder / "b.seq").write_bytes(b"")
    reader.pushFilters([getattr(formats, kind)(("path",), value.format(folder)) for kind, value in filters])
    assert len(opened(reader)) == files


def test_nothing_there(registered, tmp_path):
    for name in ("seq_headers", "frame_index", "index_endpoints"):
        assert registered.read.format(name).load(str(tmp_path / "none")).count() == 0
    with pytest.raises(Exception, match="directory"):
        registered.read.format("seq_headers").load().count()
