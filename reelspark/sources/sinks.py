"""Sinks. All of them write in parallel; none gathers rows on the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from reelspark.operators.frames import relative_timecodes


def write_parquet(
    df: DataFrame, path: str, drop: Sequence[str] = (), partition_by: Sequence[str] = (), mode: str = "overwrite"
) -> None:
    """Parquet without the named helper columns."""
    df.drop(*drop).write.mode(mode).partitionBy(*partition_by).parquet(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Nested reports and state as JSON lines."""
    df.write.mode(mode).json(path)


def append_run_log(df: DataFrame, line: Column, path: str) -> None:
    """Append one formatted line per result."""
    df.select(line.alias("value")).write.mode("append").text(path)


def write_report(df: DataFrame, line: Column, path: str, order: Sequence[str | Column]) -> None:
    """Text report, one line per row, in the stated order across the part files."""
    df.orderBy(*order).select(line.alias("value")).write.mode("overwrite").text(path)


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_timecodes(frames: DataFrame, path: str, header: str = "# timestamp format v2") -> None:
    """Per file a header line and the milliseconds since its first frame, in frame order.

    Range partitioning keeps the order across part files and lets a long file span several of them."""
    lines = relative_timecodes(frames).select("file", "rec_no", F.format_string("%.3f", "timecode_ms").alias("value"))
    heads = frames.select("file").distinct().select("file", F.lit(-1).cast("long").alias("rec_no"),
                                                    F.lit(header).alias("value"))
    (
        heads.unionByName(lines)
        .repartitionByRange("file", "rec_no")
        .sortWithinPartitions("file", "rec_no")
        .select("file", "value")
        .write.mode("overwrite").partitionBy("file").text(path)
    )
