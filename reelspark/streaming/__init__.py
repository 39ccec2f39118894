from reelspark.streaming.live import (  # noqa: F401
    STATE_STORE, capture_bursts_stream, duration_updates, ingest_batch, ingest_status, live_pose, stall_alerts,
    sync_monitor,
)
