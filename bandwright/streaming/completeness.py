"""Exact group completeness on a stream, window by window."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import TimestampNTZType

from ..functions.checks import require_columns, require_duration, require_positive


def stream_completeness(
    readings: DataFrame,
    group: str,
    key: str,
    ts: str,
    expected: int,
    *,
    duration: str = "24 hours",
    watermark: str = "1 hour",
    count_name: str = "distinct_keys",
) -> DataFrame:
    """Distinct non-NULL entities per group and window of `duration`, and `is_valid`: whether there are exactly `expected`.

    Two stateful steps one after the other. The first keeps each (window, group, entity) once, so that its state is bounded
    by the entities of open windows; the second counts them. A window is judged when the watermark has passed its end, in
    append mode, and what comes later than the watermark counts no more. Also runs on a batch frame, over all windows.
    """
    require_columns(readings, (group, key, ts))
    require_positive("expected", expected)
    require_duration("duration", duration)
    require_duration("watermark", watermark)
    if isinstance(readings.schema[ts].dataType, TimestampNTZType):
        readings = readings.withColumn(ts, F.col(ts).cast("timestamp"))
    seen = readings.withWatermark(ts, watermark).select(F.window(ts, duration).alias("window"), group, key)
    counted = seen.dropDuplicates(["window", group, key]).groupBy("window", group).agg(F.count(key).alias(count_name))
    return counted.select(
        group,
        F.col("window.start").alias("start"),
        F.col("window.end").alias("end"),
        count_name,
        (F.col(count_name) == expected).alias("is_valid"),
    )


def write_stream_completeness(
    readings: DataFrame, group: str, key: str, ts: str, expected: int, *, path: str, checkpoint: str, **options
) -> StreamingQuery:
    """Append each judged window of `stream_completeness` to a Parquet folder; processes what has arrived, then stops."""
    found = stream_completeness(readings, group, key, ts, expected, **options)
    writer = found.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return writer.outputMode("append").trigger(availableNow=True).start()
