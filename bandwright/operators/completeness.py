"""Group completeness: does each file (or other group) hold the expected number of entities?"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, Observation, functions as F

from ..functions.checks import require_columns, require_positive


def group_completeness(
    df: DataFrame,
    group: str,
    key: str,
    expected: int,
    count_name: str = "distinct_keys",
    approximate: bool = False,
) -> DataFrame:
    """Distinct non-NULL entities per group and `is_valid`: whether there are exactly `expected`.

    Spark first reduces to distinct (group, key) pairs inside each task and shuffles on both columns, then
    sums counts per group, so one huge file is spread over many tasks. A stream cannot count distinct
    values exactly, so it is refused: judge its micro-batches (`scope="batch"`), or ask for `approximate`
    counts, which come as `approx_<count_name>` and without a verdict.
    """
    require_columns(df, (group, key))
    require_positive("expected", expected)
    if approximate:
        return df.groupBy(group).agg(F.approx_count_distinct(key).alias(f"approx_{count_name}"))
    if df.isStreaming:
        raise ValueError("a stream cannot count distinct values exactly; pass approximate=True or judge batches")
    return (
        df.groupBy(group)
        .agg(F.count_distinct(F.col(key)).alias(count_name))
        .withColumn("is_valid", F.col(count_name) == expected)
    )


def incomplete_groups(completeness: DataFrame) -> DataFrame:
    """The groups that failed `group_completeness`."""
    return completeness.where(~F.col("is_valid"))


def log_incomplete_groups(completeness: DataFrame, logger: logging.Logger, lines: int = 100) -> int:
    """Log how many groups failed, and the first `lines` of them by name; return how many failed.

    The log holds examples only; `incomplete_groups`, and the stored completeness, hold them all.
    """
    group, count = completeness.columns[:2]
    seen = Observation()
    # One job: the first by name are picked from all that failed, so all are counted on the way.
    failed = incomplete_groups(completeness).select(group, count)
    first = failed.observe(seen, F.count(F.lit(1)).alias("groups")).sort(group).take(max(1, lines))
    total = seen.get["groups"]
    if total:
        logger.error("%d groups are incomplete or hold too much; the first %d:", total, min(total, lines))
        for row in first[:lines]:
            logger.error("%s %r holds %d distinct entities", group, row[group], row[count])
    return total
