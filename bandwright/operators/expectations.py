"""Row expectations of the warning kind: rows pass unchanged, violations are counted on the way."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, functions as F

ROWS = "rows"


def _counters(rules: Mapping[str, str | Column]) -> list[Column]:
    if not rules:
        raise ValueError("at least one expectation is needed")
    if ROWS in rules:
        raise ValueError(f"{ROWS!r} is the name of the row counter")
    counters = [F.count(F.lit(1)).alias(ROWS)]
    for name, rule in rules.items():
        holds = F.expr(rule) if isinstance(rule, str) else rule
        counters.append(F.count_if(~F.coalesce(holds, F.lit(False))).alias(name))
    return counters


def expect(
    df: DataFrame, rules: Mapping[str, str | Column], observation: Observation | str | None = None
) -> tuple[DataFrame, Observation | str]:
    """Attach named predicates to a frame; a row violates one unless it is true, so NULL violates too.

    The counts cost no extra pass: they are taken while the returned frame is written. Batch: read
    `observation.get` after the first action. Stream: pass a name, read it from the query progress.
    """
    if observation is None:
        observation = "expectations" if df.isStreaming else Observation()
    return df.observe(observation, *_counters(rules)), observation


def expectation_counts(df: DataFrame, rules: Mapping[str, str | Column]) -> DataFrame:
    """The same counts as a frame: one row with `rows` and one column of violations per rule."""
    return df.agg(*_counters(rules))
