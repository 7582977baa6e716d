from .completeness import stream_completeness, write_stream_completeness
from .incremental import ingest, ingest_batches, merged_profile, rebuild, run_incremental, write_batch
from .lake import Lake, Version
from .windows import write_window_stats

__all__ = [
    "Lake",
    "Version",
    "ingest",
    "ingest_batches",
    "merged_profile",
    "rebuild",
    "run_incremental",
    "stream_completeness",
    "write_batch",
    "write_stream_completeness",
    "write_window_stats",
]
