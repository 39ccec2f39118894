"""Session for tests and the bench, and the package for executors; cluster jobs bring their own session."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def ship(spark: SparkSession) -> None:
    """Give Python workers the package, once per application, wherever they run."""
    context = spark.sparkContext
    if getattr(context, "_reelspark_shipped", False):
        return
    package = os.path.join(tempfile.mkdtemp(), "reelspark.zip")
    with zipfile.ZipFile(package, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(os.path.join(ROOT, "reelspark")):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, ROOT))
        for name in os.listdir(ROOT):
            if name.endswith("_pipeline.py"):
                z.write(os.path.join(ROOT, name), name)
    context.addPyFile(package)
    context._reelspark_shipped = True


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, memory: str = "16g") -> SparkSession:
    """Session for tests and the bench; cluster jobs bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("reelspark")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        # small shuffles keep their partitions: local runs are bound by cores, not by bytes
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
