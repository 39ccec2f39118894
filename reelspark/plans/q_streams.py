"""Bounded runs of the streams over the event table."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from reelspark.plans.registry import query
from reelspark.streaming.bounded import run_bounded
from reelspark.streaming.live import capture_bursts_stream, stall_alerts


def events(spark: SparkSession, d: str) -> DataFrame:
    """The event table as a stream. A stream reads folders or patterns, and the table may be one file: hence the pattern."""
    schema = spark.read.parquet(f"{d}/events.parquet").schema
    rows = spark.readStream.schema(schema).parquet(f"{d}/event[s].parquet")
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def live_frames(rows: DataFrame) -> DataFrame:
    """Each event as a frame of its user's video; it shows a person but for errors, and a usable one by its k."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    return rows.select(
        F.col("user_id").cast("string").alias("video"), F.col("event_id").alias("frame"),
        (F.col("event_type") != "error").alias("good"), (k >= 10).alias("usable"), "ts")


STALL_SECONDS = 6 * 3600


# alerts: every pause between advances of a job that is longer than the timeout, and the last one if event time got so far
@query("stall_alerts", f"""
    SELECT job, frame, since AS stalled_since
    FROM (SELECT CAST(user_id AS VARCHAR) AS job, event_id AS frame, ts AS since,
                 lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS after,
                 max(ts) OVER () - INTERVAL 1 MINUTE AS watermark
          FROM (SELECT * FROM (SELECT *, max(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id
                                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best FROM events)
                WHERE best IS NULL OR event_id > best))
    WHERE coalesce(after, watermark) - since > INTERVAL {STALL_SECONDS} SECOND""")
def _(s, d):
    progress = events(s, d).select(F.col("user_id").cast("string").alias("job"), F.col("event_id").alias("frame"), "ts")
    return run_bounded(stall_alerts(progress, STALL_SECONDS))


# order-dependent fold: compared with its batch twin in the tests
@query("stream_bursts")
def _(s, d):
    return run_bounded(capture_bursts_stream(live_frames(events(s, d)), gap=3, cooldown=12, idle_seconds=60))
