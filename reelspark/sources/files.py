"""Tables, listings and small JSON files as DataFrames."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from reelspark.constants import KEYPOINTS
from reelspark.functions import file_name, parse_crop_name
from reelspark.sources.remote import open_filesystem

RUN_RESULT_SCHEMA = """
    run_name string,
    config struct<epochs: int, lr: double, temperature: double, batch_size: int>,
    best_loss double, final_loss double, loss_history array<double>
"""
PROCESSED_SCHEMA = "path string, output_path string, status string, timestamp string"
KEYPOINT_SCHEMA = "Frame_ID bigint, Timestamp double, Track_ID bigint, " + ", ".join(
    f"{k}_{part} double" for k in KEYPOINTS for part in ("x", "y", "conf")
)


def load_table(
    spark: SparkSession, name: str, schema: StructType | str, jdbc: dict[str, str] | None = None
) -> DataFrame:
    """A catalogue table with its declared columns; a missing table is an empty frame.

    `jdbc` holds reader options (url, driver, …) of a live catalogue when a driver jar is present."""
    empty = spark.createDataFrame([], schema)
    if jdbc is not None:
        return spark.read.format("jdbc").options(dbtable=name, **jdbc).load()
    if not spark.catalog.tableExists(name):
        return empty
    return spark.table(name).select(*[F.col(f.name).cast(f.dataType) for f in empty.schema.fields])


LISTING = pa.schema([
    ("path", pa.string()), ("is_dir", pa.bool_()), ("length", pa.int64()), ("modificationTime", pa.timestamp("us", "UTC")),
])
LISTING_SCHEMA = "path string, is_dir boolean, length bigint, modificationTime timestamp"


def _expand(recursive: bool, suffix: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Replace directories by their entries; files pass through. Unreadable directories are skipped."""

    def entries(uri: str) -> list[dict]:
        system, inner = open_filesystem(uri)
        prefix = uri[: len(uri) - len(inner)] if uri.endswith(inner) else ""
        out = []
        try:
            found = system.get_file_info(pafs.FileSelector(inner, recursive=recursive))
        except OSError:
            return out
        for info in found:
            is_dir = info.type == pafs.FileType.Directory
            if (is_dir and not recursive) or (info.type == pafs.FileType.File and info.path.lower().endswith(suffix)):
                out.append({"path": prefix + info.path, "is_dir": is_dir, "length": None if is_dir else info.size,
                            "modificationTime": info.mtime})
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[dict] = []
            for row in batch.to_pylist():
                rows += entries(row["path"]) if row["is_dir"] else [row]
            for at in range(0, len(rows), 10000):
                yield pa.RecordBatch.from_pylist(rows[at:at + 10000], schema=LISTING)

    return run


def scan_files(spark: SparkSession, root: str, extension: str | None = None, levels: int = 3) -> DataFrame:
    """Recursive listing (path, length, modificationTime); the extension matches in any case.

    Empty files are part of the listing, which is why the built-in file index is not used. The first `levels`
    directory levels (date, case, camera) are spread over the cluster one after the other, deeper ones are
    walked inside the task of their directory. Only names and sizes are read."""
    suffix = (extension or "").lower()
    found = spark.createDataFrame([(root.rstrip("/") or "/", True, None, None)], LISTING_SCHEMA)
    for level in range(levels + 1):
        found = found.mapInArrow(_expand(level == levels, suffix), LISTING_SCHEMA)
        if level < levels:
            found = found.repartition(8 * spark.sparkContext.defaultParallelism, "path")  # a given number is not merged
    return found.select("path", "length", "modificationTime")


def scan_crops(spark: SparkSession, root: str) -> DataFrame:
    """Image listing with its parsed key; rows with a NULL key are the parse failures."""
    listing = scan_files(spark, root, ".jpg").withColumn("name", file_name("path"))
    return listing.withColumn("key", parse_crop_name("name")).select(
        "path", "name", "length", "key.case_no", "key.video_idx", "key.frame_id"
    )


def read_keypoints(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(KEYPOINT_SCHEMA).parquet(path)


def read_run_results(spark: SparkSession, path: str) -> DataFrame:
    """Training run reports, one JSON document per file."""
    return spark.read.schema(RUN_RESULT_SCHEMA).option("multiLine", True).json(path)


def loss_curve(runs: DataFrame) -> DataFrame:
    """One row per recorded loss."""
    return runs.select("run_name", F.posexplode("loss_history").alias("step", "loss"))


def read_processed_state(spark: SparkSession, path: str) -> DataFrame:
    """State map {path: {output_path, status, timestamp}} as rows; missing or corrupt state is empty."""
    entry = "map<string, struct<output_path: string, status: string, timestamp: string>>"
    try:
        raw = spark.read.text(path, wholetext=True)
    except AnalysisException:
        return spark.createDataFrame([], PROCESSED_SCHEMA)
    entries = raw.select(F.explode(F.from_json("value", entry)).alias("path", "entry"))
    return entries.filter(F.col("path").isNotNull()).select("path", "entry.*")
