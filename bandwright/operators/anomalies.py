"""Anomalies: readings strictly outside mean ± k deviations of their entity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.checks import require_choice, require_columns, require_positive
from ..functions.missing import is_infinite, nan_to_null
from .baseline import (
    BROADCAST_BYTES,
    HIGH,
    LOW,
    MEAN,
    PLANS,
    STDDEV,
    WINDOW_READINGS,
    Baseline,
    fit_baseline,
    join_bounds,
    largest_entity,
    windowed_bounds,
)


def detect_anomalies(
    df: DataFrame,
    key: str,
    value: str,
    k: float = 2.0,
    keep: Sequence[str] | None = None,
    baseline: Baseline | None = None,
    *,
    label: str | None = None,
    nan_is_null: bool = True,
    zero_band: str = "constant",
    broadcast_bytes: int = BROADCAST_BYTES,
    same_rows: bool | None = None,
    plan: str = "join",
) -> DataFrame:
    """Readings above or below their band, with the `mean_<label>` and `stddev_<label>` they were judged by.

    The band comes from all rows of `df`, incomplete ones included: only a missing value is skipped. It is
    fitted when this function is called, unless `baseline` brings one from elsewhere (stored history, or
    any batch frame when `df` is a stream).

    `keep` lists the output columns in order (default: all of `df`, then the two statistics). A NaN value
    counts as missing; with `nan_is_null=False` it takes part in the statistics and comparisons as is. An infinite
    value is an anomaly and shapes no band.

    `same_rows=True` says that a `baseline` passed in was fitted on these very rows. For `plan` see `clean`.
    """
    require_columns(df, (key, value))
    require_positive("k", k)
    label = label or value
    mean, stddev = f"mean_{label}", f"stddev_{label}"
    keep = list(keep or [*df.columns, mean, stddev])
    require_columns(df, set(keep) - {mean, stddev})

    require_choice("plan", plan, PLANS)
    if same_rows is None:
        same_rows = baseline is None
    reading, there = nan_to_null(df, value) if nan_is_null else F.col(value), df.where(F.col(value).isNotNull())
    if plan == "window" and baseline is None and largest_entity(there, key) <= WINDOW_READINGS:
        judged = windowed_bounds(there, key, F.when(~is_infinite(df, value), reading), k, zero_band)
    else:
        if baseline is None:
            baseline = fit_baseline(df, key, value, nan_is_null=nan_is_null)
        judged = join_bounds(there, baseline, baseline.bounds(k, zero_band), same_rows, broadcast_bytes)
    statistics = {mean: F.col(MEAN).alias(mean), stddev: F.col(STDDEV).alias(stddev)}
    outside = (reading > F.col(HIGH)) | (reading < F.col(LOW)) | is_infinite(df, value)
    return judged.where(outside).select(
        *(statistics.get(name, F.col(name)) for name in keep)
    )
