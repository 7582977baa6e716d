"""The table-graph flow: new files are ingested exactly once, everything else follows from them.

    bronze ──> cleaned ──> stats
       ├─────> anomalies
       ├─────> rejected
       └─────> completeness

Two scopes, because they judge the same reading differently:

* `history`: bronze grows by a stream; the other tables are recomputed from all of bronze and published together. The
  statistics that readings are judged by are not: those of new readings are merged into the stored ones.
* `batch`: each micro-batch is judged on its own and its results are kept under its batch number.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..functions.audit import LOAD_DATE, with_load_columns
from ..functions.checks import require_choice
from ..operators.baseline import BROADCAST_BYTES, Profile, merge_profiles
from ..operators.expectations import expect
from ..plans.batch import CONDITIONAL, OUTPUTS, Outputs, derive, profiled
from ..sources.files import REMEMBER_DAYS, admit_late_files, stream_csv
from ..spec import ReadingSpec
from .lake import BATCH_ID, BRONZE, Lake, Version

logger = logging.getLogger(__name__)

SCOPES = ("history", "batch")
BATCHES = "batches"
_STATE = "profile"


def _run(readings: DataFrame, checkpoint: str, of_batch: Callable[[DataFrame, int], None]) -> list[int]:
    """Hand all files that have arrived since the last call to `of_batch`, then return the numbers of the micro-batches."""
    done: list[int] = []

    def each(batch: DataFrame, batch_id: int) -> None:
        of_batch(batch, batch_id)
        done.append(batch_id)

    query = readings.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    query.trigger(availableNow=True).start().awaitTermination()
    return sorted(set(done))


def _store(
    batch: DataFrame, batch_id: int, lake: Lake, query: str, partition_by: tuple[str, ...], rules: Mapping | None
) -> datetime:
    """Write a micro-batch to its own partition of bronze and its counts to the ledger; return its load time.

    A micro-batch may be replayed after a failure. Its load time is noted before any row is written, so the replay writes
    the same partition and replaces the rows.
    """
    spark = batch.sparkSession
    noted = lake.recorded(spark, query, batch_id).get("loaded")
    as_of = datetime.fromisoformat(noted) if noted else datetime.now(timezone.utc)
    if not noted:
        lake.record(spark, query, batch_id, loaded=as_of.isoformat())
    rows = with_load_columns(batch, as_of).withColumn(BATCH_ID, F.lit(batch_id).cast("long"))
    # Nothing is written if bronze has these columns already.
    lake.publish(spark, {BRONZE: (BRONZE, rows.schema)})
    table, counts = lake.table(BRONZE, partition_by), Observation()
    if table:
        table.create(spark, rows.schema)
    if rules:
        rows, _ = expect(rows, rules, counts)
    _replace(rows, lake, BRONZE, partition_by)
    if table:
        table.refresh(spark)
    if rules:
        found = {rule: count or 0 for rule, count in counts.get.items()}
        lake.record(spark, query, batch_id, loaded=as_of.isoformat(), violations=found)
    return as_of


def _replace(rows: DataFrame, lake: Lake, folder: str, partition_by: tuple[str, ...]) -> None:
    """Write rows in place of those in the same partitions."""
    writer = rows.write.format(lake.format).mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by).save(lake.path(folder))


def _sized(name: str, frame: DataFrame) -> DataFrame:
    """Outputs that are a small part of a large scan get merged into files of sensible size."""
    return frame.hint("rebalance") if name in CONDITIONAL else frame


def ingest(readings: DataFrame, lake: Lake, *, rules: Mapping[str, str | Column] | None = None) -> dict[str, int]:
    """Append all files that have arrived since the last call to bronze, each exactly once, then return.

    `readings` is a file stream; the checkpoint remembers which files were taken. Rows get load columns and the number of
    their micro-batch on the way and are written where they were read: no shuffle. Returns the expectation counts of all
    micro-batches of this call, from the ledger.
    """
    spark = readings.sparkSession

    def store(batch: DataFrame, batch_id: int) -> None:
        _store(batch, batch_id, lake, BRONZE, (*LOAD_DATE, BATCH_ID), rules)

    if rules:
        # A rule that bronze cannot answer fails here, not in a micro-batch.
        expect(with_load_columns(readings), rules, "rules")
    return lake.violations(spark, BRONZE, _run(readings, lake.checkpoint(BRONZE), store))


def merged_profile(spark: SparkSession, lake: Lake, spec: ReadingSpec, version: Version) -> tuple[Profile, dict]:
    """The statistics of all of bronze, and the note under which they are stored.

    Only micro-batches after those of the stored statistics are read and fitted; theirs are merged into them and stored
    anew. Statistics fitted for another entity, value or set of columns are not used.
    """
    bronze = lake.read(spark, BRONZE, version)
    kind = [spec.key, spec.value, spec.nan_is_null, spec.judged_columns(bronze.columns)]
    note = version.notes.get(_STATE)
    last = bronze.agg(F.max(BATCH_ID)).first()[0]
    stored = None
    if note and note["kind"] == kind:
        if note["through"] == last:
            return _loaded(spark, lake, note), note
        stored, bronze = _loaded(spark, lake, note), bronze.where(F.col(BATCH_ID) > note["through"])
    found = profiled(bronze, spec)
    if stored is not None:
        found = merge_profiles(stored, found)
    folder = lake.fresh_folder("_profile")
    found.frame.write.parquet(lake.path(folder))
    note = {"folder": folder, "kind": kind, "through": last, "schema": found.frame.schema.jsonValue(), **found.sizes}
    return _loaded(spark, lake, note), note


def _loaded(spark: SparkSession, lake: Lake, note: Mapping) -> Profile:
    frame = spark.read.schema(StructType.fromJson(note["schema"])).parquet(lake.path(note["folder"]))
    names = ("key", "entities", "readings", "key_bytes", "used", "counters")
    return Profile(frame, **{name: note[name] for name in names})


def rebuild(spark: SparkSession, lake: Lake, spec: ReadingSpec, **options) -> Version:
    """Recompute every derived table from all of bronze and publish them at once.

    Each table is written to a folder of its own, and only when all are there do readers see any of them; a failure on the
    way leaves the former tables whole. Bronze is read once for judging, and its new micro-batches once for fitting.
    """
    as_of, version = datetime.now(timezone.utc), lake.version(spark)
    found, note = merged_profile(spark, lake, spec, version)
    written, tables = {}, {}
    with derive(lake.read(spark, BRONZE, version), spec, as_of, found=found, **options) as outputs:
        for name in OUTPUTS:
            frame, folder = _sized(name, getattr(outputs, name)), lake.fresh_folder(name)
            frame.write.format(lake.format).partitionBy(*LOAD_DATE).save(lake.path(folder))
            written[name] = (folder, frame.schema)
            tables[name] = lake.table(name, folder=folder)
    published = lake.publish(spark, written, {_STATE: note}, version)
    for name, table in tables.items():
        if table:
            table.point(spark, written[name][1])
    return published


def write_batch(
    batch: DataFrame,
    batch_id: int,
    lake: Lake,
    spec: ReadingSpec,
    *,
    rules: Mapping[str, str | Column] | None = None,
    **options,
) -> None:
    """Judge one micro-batch by its own readings and store the results under its number.

    The files are parsed once, on the way into bronze; all else reads the partition of this batch there. Every table is
    overwritten in that partition only, so a replay replaces its rows instead of repeating them.
    """
    spark = batch.sparkSession
    as_of = _store(batch, batch_id, lake, BATCHES, (BATCH_ID,), rules)
    raw = lake.read(spark, BRONZE).where(F.col(BATCH_ID) == batch_id).drop(BATCH_ID)
    with derive(raw, spec, as_of, **options) as outputs:
        frames = {
            name: getattr(outputs, name).withColumn(BATCH_ID, F.lit(batch_id).cast("long")) for name in OUTPUTS
        }
        lake.publish(spark, {name: (name, frame.schema) for name, frame in frames.items()})
        for name, frame in frames.items():
            table = lake.table(name, (BATCH_ID,))
            if table:
                table.create(spark, frame.schema)
            _replace(_sized(name, frame), lake, name, (BATCH_ID,))
            if table:
                table.refresh(spark)


def ingest_batches(
    readings: DataFrame,
    lake: Lake,
    spec: ReadingSpec,
    *,
    rules: Mapping[str, str | Column] | None = None,
    **options,
) -> dict[str, int]:
    """Run `write_batch` on all files that have arrived since the last call, then return the expectation counts, each
    micro-batch counted once however often it is tried."""
    done = _run(
        readings,
        lake.checkpoint(BATCHES),
        lambda batch, batch_id: write_batch(batch, batch_id, lake, spec, rules=rules, **options),
    )
    return lake.violations(readings.sparkSession, BATCHES, done)


def run_incremental(
    spark: SparkSession,
    source_dir: str,
    lake: Lake | str,
    spec: ReadingSpec,
    *,
    scope: str = "history",
    rules: Mapping[str, str | Column] | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    archive_dir: str | None = None,
    remember_days: int = REMEMBER_DAYS,
    **csv_options,
) -> dict[str, int]:
    """Take in the CSV files that are new in `source_dir` and bring all tables up to date.

    `scope="batch"` without `maxFilesPerTrigger` takes the whole backlog as one micro-batch. With `archive_dir` files
    that were read are moved there, so that neither the folder nor the stream's log of names grows for ever; what arrives
    late is still taken in (`admit_late_files`). Returns the expectation counts.
    """
    require_choice("scope", scope, SCOPES)
    lake = Lake(lake) if isinstance(lake, str) else lake
    if archive_dir:
        seen = lake.read(spark, BRONZE) if BRONZE in lake.version(spark).tables else None
        admit_late_files(spark, source_dir, seen, spec.group, remember_days)
        csv_options |= {"archive_dir": archive_dir, "remember_days": remember_days}
    readings = stream_csv(
        spark, source_dir, spec.schema, file_column=spec.group, corrupt_column=spec.corrupt_column, **csv_options
    )
    if scope == "batch":
        return ingest_batches(readings, lake, spec, rules=rules, broadcast_bytes=broadcast_bytes)
    counts = ingest(readings, lake, rules=rules)
    if BRONZE not in lake.version(spark).tables:
        logger.info("no readings have arrived in %s yet", source_dir)
    else:
        rebuild(spark, lake, spec, broadcast_bytes=broadcast_bytes)
    return counts
