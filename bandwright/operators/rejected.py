"""Rejected rows: rows with a missing value, listed for inspection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..functions.missing import is_incomplete


def rejected_rows(
    df: DataFrame, subset: Sequence[str] | None = None, nan_is_null: bool = True
) -> DataFrame:
    """Rows with NULL (or NaN, unless `nan_is_null=False`) in any column of `subset` (default: all).

    The exact complement of the rows that `clean` judges. A plain filter, so it also runs on a stream.
    """
    return df.where(is_incomplete(df, subset, nan_is_null))
