"""Predicates for missing values, written so that the null tests reach the file scan."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, FloatType

from .checks import require_columns


def _floating(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (DoubleType, FloatType))


def _names(df: DataFrame, subset: Sequence[str] | None) -> list[str]:
    names = list(df.columns if subset is None else subset)
    if not names:
        raise ValueError("at least one column is needed")
    require_columns(df, names)
    return names


def is_complete(df: DataFrame, subset: Sequence[str] | None = None, nan_is_null: bool = True) -> Column:
    """True where no column of `subset` (default: all) is NULL, or NaN when `nan_is_null`.

    Same rows as `df.dropna("any", subset)`, but as a conjunction of IS NOT NULL tests, which a columnar
    source can use to skip row groups. Never NULL itself.
    """
    tests = []
    for name in _names(df, subset):
        tests.append(F.col(name).isNotNull())
        if nan_is_null and _floating(df, name):
            tests.append(~F.isnan(name))
    return reduce(and_, tests)


def is_incomplete(df: DataFrame, subset: Sequence[str] | None = None, nan_is_null: bool = True) -> Column:
    """Exact complement of `is_complete`."""
    tests = []
    for name in _names(df, subset):
        tests.append(F.col(name).isNull())
        if nan_is_null and _floating(df, name):
            tests.append(F.isnan(name))
    return reduce(or_, tests)


def is_infinite(df: DataFrame, name: str) -> Column:
    """True where a floating-point column is infinite; never for other types."""
    if _floating(df, name):
        return F.coalesce(F.abs(F.col(name)) == F.lit(float("inf")), F.lit(False))
    return F.lit(False)


def nan_to_null(df: DataFrame, name: str) -> Column:
    """The column with NaN turned into NULL, so that one NaN cannot spoil an aggregate."""
    if _floating(df, name):
        return F.nanvl(F.col(name), F.lit(None).cast(df.schema[name].dataType))
    return F.col(name)
