"""The quality gate: everything that is wrong with a set of readings."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from ..functions.checks import require_columns
from ..functions.missing import is_complete, is_incomplete, is_infinite, nan_to_null
from ..spec import ReadingSpec
from .anomalies import detect_anomalies
from .baseline import BROADCAST_BYTES, HIGH, LOW, Baseline, band, join_bounds, profile
from .completeness import group_completeness
from .rejected import rejected_rows


class QualityReport(NamedTuple):
    anomalies: DataFrame
    rejected: DataFrame
    completeness: DataFrame


def quality_report(
    df: DataFrame,
    spec: ReadingSpec,
    baseline: Baseline | None = None,
    *,
    same_rows: bool | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> QualityReport:
    """Anomalies, rejected rows and group completeness of one frame of readings."""
    require_columns(df, (*spec.required, spec.group))
    return QualityReport(
        detect_anomalies(
            df,
            spec.key,
            spec.value,
            spec.k,
            spec.anomaly_columns,
            baseline,
            label=spec.label,
            nan_is_null=spec.nan_is_null,
            zero_band=spec.zero_band,
            broadcast_bytes=broadcast_bytes,
            same_rows=same_rows,
        ),
        rejected_rows(df, spec.judged_columns(df.columns), spec.nan_is_null),
        group_completeness(df, spec.group, spec.key, spec.expected_keys, spec.count_name),
    )


def quality_counts(
    df: DataFrame, key: str, value: str, k: float = 2.0, *, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Rows of `outcome` and `readings`: how many of `df` are cleaned, anomalies, rejected, and there in all.

    One pass fits both bands and counts rejected rows; one more joins each reading with both bands and counts what
    is inside the one and outside the other. `clean` and `detect_anomalies` give the rows themselves.
    """
    complete, counters = is_complete(df), {"rejected": is_incomplete(df)}
    found = profile(df, key, value, {"complete": complete, "raw": None}, True, counters)
    (inner_low, inner_high), (low, high) = band("complete", k), band("raw", k)
    both = found.frame.where(F.col(key).isNotNull()).select(
        key, inner_low.alias("__from"), inner_high.alias("__to"), low.alias(LOW), high.alias(HIGH)
    )
    known = df.where(F.col(key).isNotNull() & F.col(value).isNotNull())
    judged = join_bounds(known, found.baseline("raw"), both, True, broadcast_bytes)
    reading, infinite = nan_to_null(df, value), is_infinite(df, value)
    counts = judged.agg(
        F.count_if(complete & reading.between(F.col("__from"), F.col("__to")) & ~infinite).alias("cleaned"),
        F.count_if((reading > F.col(HIGH)) | (reading < F.col(LOW)) | infinite).alias("anomalies"),
    )
    outcomes = {
        "cleaned": F.col("cleaned"),
        "anomalies": F.col("anomalies"),
        "rejected": F.lit(found.counters["rejected"]).cast("long"),
        "total": F.lit(found.readings).cast("long"),
    }
    rows = [F.struct(F.lit(name).alias("outcome"), n.alias("readings")) for name, n in outcomes.items()]
    return counts.select(F.inline(F.array(*rows)))
