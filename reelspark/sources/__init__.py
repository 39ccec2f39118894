from reelspark.sources.containers import (  # noqa: F401
    rebuild_frame_index, scan_frame_index, scan_index_endpoints, scan_seq_headers,
)
from reelspark.sources.files import (  # noqa: F401
    load_table, loss_curve, read_keypoints, read_processed_state, read_run_results, scan_crops, scan_files,
)
from reelspark.sources.formats import FrameIndex, IndexEndpoints, SeqHeaders, register  # noqa: F401
from reelspark.sources.sinks import (  # noqa: F401
    append_run_log, export_csv, write_json, write_parquet, write_report, write_timecodes,
)
