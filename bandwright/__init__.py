"""Quality checks and statistics for time-stamped readings, on Spark."""

from .contracts import ContractError, DatasetContract
from .functions import EmptyFrameError, MissingColumnsError, is_complete, is_incomplete, with_load_columns
from .operators import (
    Baseline,
    QualityReport,
    clean,
    detect_anomalies,
    expect,
    expectation_counts,
    fit_baseline,
    group_completeness,
    incomplete_groups,
    load_baseline,
    log_incomplete_groups,
    merge_baselines,
    quality_counts,
    quality_report,
    rejected_rows,
    store_baseline,
    window_stats,
)
from .plans import Outputs, run_batch, write_outputs
from .sinks import (
    ManagedTable,
    UnavailableFormatError,
    write_contract,
    write_csv,
    write_delta,
    write_jdbc,
    write_parquet,
)
from .sources import admit_late_files, read_contract, read_csv, read_table, stream_csv
from .spec import ReadingSpec
from .streaming import Lake, run_incremental, stream_completeness, write_stream_completeness, write_window_stats

__all__ = [
    "Baseline",
    "ContractError",
    "DatasetContract",
    "EmptyFrameError",
    "Lake",
    "ManagedTable",
    "MissingColumnsError",
    "Outputs",
    "QualityReport",
    "ReadingSpec",
    "UnavailableFormatError",
    "admit_late_files",
    "clean",
    "detect_anomalies",
    "expect",
    "expectation_counts",
    "fit_baseline",
    "group_completeness",
    "incomplete_groups",
    "is_complete",
    "is_incomplete",
    "load_baseline",
    "log_incomplete_groups",
    "merge_baselines",
    "quality_counts",
    "quality_report",
    "read_contract",
    "read_csv",
    "read_table",
    "rejected_rows",
    "run_batch",
    "run_incremental",
    "store_baseline",
    "stream_completeness",
    "stream_csv",
    "window_stats",
    "with_load_columns",
    "write_contract",
    "write_csv",
    "write_delta",
    "write_jdbc",
    "write_parquet",
    "write_outputs",
    "write_stream_completeness",
    "write_window_stats",
]
