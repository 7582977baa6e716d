"""The batch flow: one set of readings in, four datasets and a completeness check out."""

from __future__ import annotations

import logging
from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..contracts import DatasetContract
from ..functions.audit import LOAD_COLUMNS, with_load_columns
from ..functions.checks import EmptyFrameError, require_columns
from ..functions.missing import is_complete, is_incomplete
from ..operators.baseline import BROADCAST_BYTES, MEAN, STDDEV, Profile, profile
from ..operators.completeness import group_completeness, log_incomplete_groups
from ..operators.routing import ANOMALY_VERDICTS, KEPT_VERDICTS, REJECTED_VERDICTS, judge, route
from ..operators.window_stats import window_stats
from ..sinks.writers import withdraw_run, write_contract
from ..sources.files import read_csv
from ..spec import ReadingSpec
from ..storage import remove

logger = logging.getLogger(__name__)

OUTPUTS = ("cleaned", "stats", "anomalies", "rejected", "completeness")
CONDITIONAL = ("anomalies", "rejected")


@dataclass
class Outputs:
    """Results of one run, read from the judged readings in the shared folder. Use as a context manager, or call `release`
    after the last write."""

    cleaned: DataFrame
    stats: DataFrame
    anomalies: DataFrame
    rejected: DataFrame
    completeness: DataFrame
    rows: int
    rejected_rows: int
    anomaly_rows: int
    path: str
    held: list[DataFrame] = field(default_factory=list, repr=False)

    def release(self) -> None:
        """Remove what this run stored or cached, and nothing else."""
        while self.held:
            self.held.pop().unpersist()
        remove(self.cleaned.sparkSession, self.path)

    def __enter__(self) -> Outputs:
        return self

    def __exit__(self, *exc) -> None:
        self.release()


def profiled(raw: DataFrame, spec: ReadingSpec) -> Profile:
    """Both baselines of a run, the complete rows' for cleaning and all rows' for anomalies, and its counts of rows."""
    judged = spec.judged_columns(raw.columns)
    complete = is_complete(raw, judged)
    # Rows are either complete or rejected, unless NaN is told apart from NULL.
    counters = {"rejected": is_incomplete(raw, judged, spec.nan_is_null), "usable": complete}
    return profile(raw, spec.key, spec.value, {"complete": complete, "raw": None}, spec.nan_is_null, counters)


def derive(
    raw: DataFrame,
    spec: ReadingSpec,
    as_of: datetime | str | None = None,
    *,
    found: Profile | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    require_non_empty: bool = False,
) -> Outputs:
    """All outputs of readings. Those without load columns get them, as constants.

    `raw` is read twice: one pass fits both baselines and counts, unless `found` brings them along; one judges every
    reading and stores it under its verdict. Each output reads only its own verdicts and columns.
    """
    require_columns(raw, (*spec.required, spec.group))
    found = found or profiled(raw, spec)
    if require_non_empty:
        if found.readings == 0:
            raise EmptyFrameError("the input holds no rows")
        if found.counters["usable"] == 0:
            raise EmptyFrameError("every input row is incomplete")
    routed = route(judge(raw, spec, found, broadcast_bytes=broadcast_bytes))
    if require_non_empty and routed.rows(KEPT_VERDICTS) == 0:
        raise EmptyFrameError("every complete row is outside its band")
    stamped = set(LOAD_COLUMNS) <= set(raw.columns)

    def stamp(df: DataFrame) -> DataFrame:
        return df if stamped else with_load_columns(df, as_of)

    label = spec.label or spec.value
    statistics = {f"mean_{label}": MEAN, f"stddev_{label}": STDDEV}
    anomalies = stamp(routed.of(ANOMALY_VERDICTS)).withColumnsRenamed({inner: name for name, inner in statistics.items()})
    every = [*raw.columns, *(() if stamped else LOAD_COLUMNS)]
    cleaned = stamp(routed.of(KEPT_VERDICTS)).select(*every)
    stats = window_stats(
        cleaned, spec.key, spec.ts, spec.value, spec.window, label=spec.label, nan_is_null=spec.nan_is_null
    )
    completeness = group_completeness(routed.frame, spec.group, spec.key, spec.expected_keys, spec.count_name)
    return Outputs(
        cleaned=cleaned,
        stats=with_load_columns(stats, as_of),
        anomalies=anomalies.select(*(spec.anomaly_columns or (*every, *statistics))),
        rejected=stamp(routed.of(REJECTED_VERDICTS)).select(*every),
        completeness=with_load_columns(completeness, as_of),
        rows=sum(routed.counts.values()),
        rejected_rows=routed.rows(REJECTED_VERDICTS),
        anomaly_rows=routed.rows(ANOMALY_VERDICTS),
        path=routed.path,
    )


def run_batch(
    spark: SparkSession,
    source: str | DataFrame,
    spec: ReadingSpec,
    *,
    as_of: datetime | str | None = None,
    storage_level: StorageLevel | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    require_non_empty: bool = False,
    **csv_options,
) -> Outputs:
    """Read (a CSV path, or take a frame), judge, and derive all outputs.

    The load time is fixed here, once for the run. Readings are read twice, from the source both times; nothing is cached
    unless `storage_level` is given. A frame that is cached already stays so.
    """
    if isinstance(source, str):
        source = read_csv(
            spark, source, spec.schema, file_column=spec.group, corrupt_column=spec.corrupt_column, **csv_options
        )
    as_of = as_of or datetime.now(timezone.utc)
    held = []
    if storage_level is not None and source.storageLevel == StorageLevel.NONE:
        held = [source.persist(storage_level)]
    try:
        outputs = derive(source, spec, as_of, broadcast_bytes=broadcast_bytes, require_non_empty=require_non_empty)
    except BaseException:
        for frame in held:
            frame.unpersist()
        raise
    outputs.held = held
    return outputs


def write_outputs(
    outputs: Outputs,
    contracts: Mapping[str, DatasetContract],
    mode: str = "append",
    *,
    run_id: str | None = None,
    incomplete_lines: int = 100,
    **write_options,
) -> dict[str, int]:
    """Write cleaned, stats, anomalies, rejected and completeness, in this order; return the rows written to each.

    Columns are put into contract order first. Anomalies and rejected rows are written only if there are any,
    completeness only if `contracts` has it. Row counts are taken by the writing job itself. How many groups fail the
    completeness check is logged, with the first `incomplete_lines` of them.

    With `run_id` every dataset is appended to as a folder of that run, which a second run under the same name replaces
    (see `write_contract`). So a run that failed between two outputs is repeated whole, and repeats no row.
    """
    if run_id is not None and mode != "append":
        raise ValueError(f"a run is appended under its name; mode {mode!r} has no use for one")
    written = {}
    empty = {"rejected": outputs.rejected_rows == 0, "anomalies": outputs.anomaly_rows == 0}
    for name in OUTPUTS:
        if name == "completeness" and name not in contracts:
            continue
        frame, contract = contracts[name].conform(getattr(outputs, name)), contracts[name]
        if empty.get(name):
            if run_id is not None:
                withdraw_run(frame.sparkSession, contract, run_id)
            logger.info("%s: none", name)
            written[name] = 0
            continue
        if name in CONDITIONAL:
            # A small part of a large scan: merge the rows of many tasks into files of sensible size.
            frame = frame.hint("rebalance")
        seen = Observation()
        frame = frame.observe(seen, F.count(F.lit(1)).alias("rows"))
        write_contract(frame, contract, mode, run_id=run_id, **write_options)
        written[name] = seen.get["rows"]
        unusual = name in CONDITIONAL or written[name] == 0
        logger.log(logging.WARNING if unusual else logging.INFO, "%s: %d rows", name, written[name])
    log_incomplete_groups(outputs.completeness, logger, incomplete_lines)
    return written
