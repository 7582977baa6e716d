"""Load audit columns: when a row was loaded, and that day's year, month and day for partitioning."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

LOAD_COLUMNS = ("insert_timestamp", "year", "month", "day")
LOAD_DATE = ("year", "month", "day")


def _instant(as_of: datetime | str | None) -> Column:
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, datetime) and as_of.tzinfo is not None:
        return F.lit(as_of)
    # A zone-less value is read in the session zone, not in the zone of the Python process.
    return F.lit(str(as_of)).cast("timestamp")


def with_load_columns(df: DataFrame, as_of: datetime | str | None = None) -> DataFrame:
    """Add `insert_timestamp`, `year`, `month`, `day`.

    Without `as_of` the time is that of each action. Pass one value per run to give every output of the
    run the same stamp, however often its plan is evaluated.
    """
    stamp = _instant(as_of)
    return df.withColumns(
        {
            "insert_timestamp": stamp,
            "year": F.year(stamp),
            "month": F.month(stamp),
            "day": F.dayofmonth(stamp),
        }
    )
