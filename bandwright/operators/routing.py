"""Judge every reading once and file it under its verdict; the outputs read what concerns them.

Both bands of a run (that of the complete rows for cleaning, that of all rows for anomalies) come from one profile, so one
join gives a reading both, and one column says what it is. The judged readings are stored once, in a folder per verdict.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..functions.missing import is_complete, is_incomplete, is_infinite, nan_to_null
from ..spec import ReadingSpec
from ..storage import fresh_path
from .baseline import BROADCAST_BYTES, HIGH, LOW, MEAN, STDDEV, Profile, band, join_bounds

VERDICT = "__verdict"
KEPT, ANOMALY, REJECTED = "kept", "anomaly", "rejected"
#: What a reading can be: with gaps in other columns a kept or rejected one may be an anomaly too.
KEPT_VERDICTS = (KEPT, f"{KEPT}_{ANOMALY}")
ANOMALY_VERDICTS = (ANOMALY, f"{KEPT}_{ANOMALY}", f"{REJECTED}_{ANOMALY}")
REJECTED_VERDICTS = (REJECTED, f"{REJECTED}_{ANOMALY}")
OTHER = "other"
_MOST_VERDICTS = 6


@contextmanager
def _open_writers(spark: SparkSession, n: int) -> Iterator[None]:
    """So many folders are written side by side, without sorting the rows by folder first."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name, None)
    spark.conf.set(name, n)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def judge(
    df: DataFrame, spec: ReadingSpec, found: Profile, *, same_rows: bool = True, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """All rows of `df` with `__verdict`, and the mean and deviation of their entity where they are anomalies.

    `found` must hold the baselines `complete` and `raw`. Rows without an entity or value are kept by nobody, and rejected
    like any other with a gap.
    """
    judged = spec.judged_columns([name for name in df.columns])
    (inner_low, inner_high), (low, high) = (
        band("complete", spec.k, spec.zero_band, spec.on_undefined), band("raw", spec.k, spec.zero_band)
    )
    bounds = found.frame.where(F.col(spec.key).isNotNull()).select(
        spec.key, inner_low.alias("__from"), inner_high.alias("__to"), low.alias(LOW), high.alias(HIGH),
        F.col(f"raw{MEAN}").alias(MEAN), F.col(f"raw{STDDEV}").alias(STDDEV),
    )
    rows = join_bounds(df, found.baseline("raw"), bounds, same_rows, broadcast_bytes, "left")
    value, infinite = F.col(spec.value), is_infinite(df, spec.value)
    reading = nan_to_null(df, spec.value) if spec.nan_is_null else value
    # An entity without a band is not judged: as in an inner join, its readings are neither kept nor anomalies.
    known = F.col(spec.key).isNotNull() & value.isNotNull()
    kept = is_complete(df, judged) & value.between(F.col("__from"), F.col("__to")) & ~infinite
    outside = known & ((reading > F.col(HIGH)) | (reading < F.col(LOW)) | infinite)
    kept, outside = (F.coalesce(flag, F.lit(False)) for flag in (kept, outside))
    rejected = is_incomplete(df, judged, spec.nan_is_null)
    name = F.when(kept, KEPT).when(rejected, REJECTED)
    verdict = F.coalesce(F.when(outside, F.concat_ws("_", name, F.lit(ANOMALY))).otherwise(name), F.lit(OTHER))
    return rows.select(
        *df.columns,
        *(F.when(outside, F.col(statistic)).alias(statistic) for statistic in (MEAN, STDDEV)),
        verdict.alias(VERDICT),
    )


@dataclass(frozen=True)
class Routed:
    """Judged readings in a folder per verdict, and how many there are of each kind."""

    frame: DataFrame
    path: str
    counts: dict[str, int]

    def of(self, verdicts: tuple[str, ...]) -> DataFrame:
        return self.frame.where(F.col(VERDICT).isin(*verdicts))

    def rows(self, verdicts: tuple[str, ...]) -> int:
        return sum(self.counts[verdict] for verdict in verdicts)


def route(judged: DataFrame) -> Routed:
    """Store the result of `judge` in the shared folder, each reading once, and read it back by verdict."""
    spark = judged.sparkSession
    path, seen = fresh_path(spark, "judged"), Observation()
    every = {*KEPT_VERDICTS, *ANOMALY_VERDICTS, *REJECTED_VERDICTS, OTHER}
    counted = judged.observe(seen, *(F.count_if(F.col(VERDICT) == name).alias(name) for name in sorted(every)))
    with _open_writers(spark, _MOST_VERDICTS):
        counted.write.partitionBy(VERDICT).parquet(path)
    counts = {name: n or 0 for name, n in seen.get.items()}
    return Routed(spark.read.schema(judged.schema).parquet(path), path, counts)
