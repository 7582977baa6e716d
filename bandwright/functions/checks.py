"""Argument checks shared by the operators. They look at schemas and parameters only, so they start no job."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame


class MissingColumnsError(ValueError):
    """The frame lacks columns that an operator needs."""


class EmptyFrameError(ValueError):
    """A frame that must hold rows holds none."""


def require_frame(df: object) -> None:
    if df is None:
        raise ValueError("a DataFrame is required, got None")
    if not isinstance(df, DataFrame):
        raise TypeError(f"a DataFrame is required, got {type(df).__name__}")


def require_columns(df: DataFrame, columns: Iterable[str]) -> None:
    require_frame(df)
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise MissingColumnsError(f"missing columns: {', '.join(missing)}")


def require_positive(name: str, value: object) -> None:
    if isinstance(value, bool) or not isinstance(value, (int, float)) or not value > 0:
        raise ValueError(f"{name} must be a positive number, got {value!r}")


def require_duration(name: str, value: object) -> None:
    if not isinstance(value, str) or not value.strip():
        raise ValueError(f"{name} must be a non-empty duration such as '24 hours', got {value!r}")


def require_choice(name: str, value: object, allowed: tuple[str, ...]) -> None:
    if value not in allowed:
        raise ValueError(f"{name} must be one of {', '.join(allowed)}, got {value!r}")


def require_rows(df: DataFrame, message: str) -> None:
    """Raise when a batch frame is empty. Runs a limit-1 job, so callers opt in."""
    if df.isStreaming:
        raise ValueError("emptiness cannot be tested on a streaming frame")
    if df.isEmpty():
        raise EmptyFrameError(message)
