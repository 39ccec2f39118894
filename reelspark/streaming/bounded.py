"""Streams over what is there now, as a table."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from reelspark.streaming.live import STATE_STORE


def scratch_dir(spark: SparkSession) -> str:
    """A new folder that driver and executors share: below `spark.checkpoint.dir`, or the warehouse where that is unset (a
    temporary folder in local sessions)."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        local = (spark.sparkContext.master or "").split("[")[0] == "local"
        base = f"file://{tempfile.gettempdir()}/reelspark" if local else spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def run_bounded(out: DataFrame) -> DataFrame:
    """The rows of a streaming DataFrame once all present input is read and event time has moved past it."""
    spark = out.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    path = scratch_dir(spark)
    query = (
        out.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True).start(f"{path}/rows")
    )
    query.awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{path}/rows")
