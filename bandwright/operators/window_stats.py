"""Summary statistics per entity and tumbling time window."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import TimestampNTZType

from ..functions.checks import require_columns, require_duration
from ..functions.missing import nan_to_null


def window_stats(
    df: DataFrame,
    key: str,
    ts: str,
    value: str,
    duration: str = "24 hours",
    watermark: str | None = None,
    label: str | None = None,
    nan_is_null: bool = True,
) -> DataFrame:
    """Minimum, maximum, mean and sample deviation of `value` per `key` and window of `duration`.

    Windows are aligned to the Unix epoch in UTC. The same call serves batch and stream; a stream in append
    mode needs `watermark` (how late a reading may be), and a window is emitted once it is closed.
    NaN counts as missing, unless `nan_is_null` is off.
    Partial aggregates leave each task, one per (entity, window), so a hot entity does not skew the shuffle.
    """
    require_columns(df, (key, ts, value))
    require_duration("duration", duration)
    label = label or value
    if watermark is not None:
        require_duration("watermark", watermark)
        if isinstance(df.schema[ts].dataType, TimestampNTZType):
            df = df.withColumn(ts, F.col(ts).cast("timestamp"))
        df = df.withWatermark(ts, watermark)
    reading = nan_to_null(df, value) if nan_is_null else F.col(value)
    return (
        df.groupBy(key, F.window(ts, duration))
        .agg(
            F.min(reading).alias(f"min_{label}"),
            F.max(reading).alias(f"max_{label}"),
            F.mean(reading).alias(f"avg_{label}"),
            F.stddev_samp(reading).alias(f"stddev_{label}"),
        )
        .select(
            key,
            F.col("window.start").alias("start"),
            F.col("window.end").alias("end"),
            *(f"{name}_{label}" for name in ("min", "max", "avg", "stddev")),
        )
    )
