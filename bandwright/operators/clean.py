"""Cleaning: complete rows whose value lies within mean ± k deviations of its entity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.checks import EmptyFrameError, require_choice, require_columns, require_positive, require_rows
from ..functions.missing import is_complete, is_infinite
from .baseline import (
    BROADCAST_BYTES,
    HIGH,
    LOW,
    PLANS,
    WINDOW_READINGS,
    Baseline,
    fit_baseline,
    join_bounds,
    largest_entity,
    windowed_bounds,
)


def clean(
    df: DataFrame,
    key: str,
    value: str,
    k: float = 2.0,
    subset: Sequence[str] | None = None,
    *,
    baseline: Baseline | None = None,
    on_undefined: str = "drop",
    zero_band: str = "constant",
    require_non_empty: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
    plan: str = "join",
) -> DataFrame:
    """Drop incomplete rows, then rows outside the band. Limits are inclusive, columns keep their order.
    Infinite values are outside every band and shape none.

    The band comes from the complete rows of `df` itself, outliers included, over all its time span. It is
    fitted when this function is called; pass `baseline` to reuse one, or to judge a stream.
    `subset` names the columns that must be present (default: all).

    `plan="window"` takes the band from window functions instead of a join with a fitted baseline, for very many entities
    of which none is hot: the largest is measured first, and above `WINDOW_READINGS` the join is taken after all.
    """
    require_columns(df, (key, value))
    require_positive("k", k)
    require_choice("plan", plan, PLANS)
    complete = is_complete(df, subset)
    if plan == "window" and baseline is None and largest_entity(df.where(complete), key) <= WINDOW_READINGS:
        rows = df.where(complete)
        finite = F.when(~is_infinite(df, value), F.col(value))
        kept = _inside(windowed_bounds(rows, key, finite, k, zero_band, on_undefined), rows, value)
        if require_non_empty:
            require_rows(kept, "no row is left")
        return kept
    same_rows = baseline is None
    if baseline is None:
        baseline = fit_baseline(df, key, value, complete)
        if require_non_empty and baseline.readings == 0:
            require_rows(df, "the input holds no rows")
            raise EmptyFrameError("every input row is incomplete")
    return clean_with(
        df.where(complete), value, k, baseline, same_rows, on_undefined, zero_band, require_non_empty,
        broadcast_bytes,
    )


def clean_with(
    complete_rows: DataFrame,
    value: str,
    k: float,
    baseline: Baseline,
    same_rows: bool,
    on_undefined: str = "drop",
    zero_band: str = "constant",
    require_non_empty: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Second half of `clean`, for callers that hold the baseline and the complete rows already."""
    bounds = baseline.bounds(k, zero_band, on_undefined)
    kept = _inside(join_bounds(complete_rows, baseline, bounds, same_rows, broadcast_bytes), complete_rows, value)
    if require_non_empty:
        require_rows(kept, "every complete row is outside its band")
    return kept


def _inside(judged: DataFrame, rows: DataFrame, value: str) -> DataFrame:
    inside = F.col(value).between(F.col(LOW), F.col(HIGH)) & ~is_infinite(rows, value)
    return judged.where(inside).select(*rows.columns)
