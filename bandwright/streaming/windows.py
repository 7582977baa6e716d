"""Streaming window statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators.window_stats import window_stats


def write_window_stats(
    readings: DataFrame,
    key: str,
    ts: str,
    value: str,
    *,
    duration: str = "24 hours",
    watermark: str,
    path: str,
    checkpoint: str,
    label: str | None = None,
) -> StreamingQuery:
    """Append each window to a Parquet folder once the watermark has passed its end; readings later than
    the watermark are dropped. Processes what has arrived, then stops; state and file positions are kept in
    `checkpoint`, so the next call goes on from there.
    """
    return (
        window_stats(readings, key, ts, value, duration, watermark, label)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
