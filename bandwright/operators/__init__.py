from .anomalies import detect_anomalies
from .baseline import (
    BROADCAST_BYTES,
    Baseline,
    Profile,
    fit_baseline,
    load_baseline,
    merge_baselines,
    merge_profiles,
    profile,
    store_baseline,
)
from .clean import clean
from .completeness import group_completeness, incomplete_groups, log_incomplete_groups
from .expectations import expect, expectation_counts
from .rejected import rejected_rows
from .report import QualityReport, quality_counts, quality_report
from .routing import Routed, judge, route
from .window_stats import window_stats

__all__ = [
    "BROADCAST_BYTES",
    "Baseline",
    "Profile",
    "QualityReport",
    "Routed",
    "clean",
    "detect_anomalies",
    "expect",
    "expectation_counts",
    "fit_baseline",
    "group_completeness",
    "incomplete_groups",
    "judge",
    "load_baseline",
    "log_incomplete_groups",
    "merge_baselines",
    "merge_profiles",
    "profile",
    "quality_counts",
    "quality_report",
    "rejected_rows",
    "route",
    "store_baseline",
    "window_stats",
]
