"""Queries over the driver's tables, one or more per operator, each with its SQL counterpart.

Missing values: the tables have none, so `_readings` takes the reading of one hour of the day away (a nightly
maintenance hour). Rows stay; only their value goes. Everything runs over whole tables.

Amounts are taken in hundredths. Sums of whole numbers are exact in any order of addition, so averages can be
compared bit for bit with those of another engine.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import bandwright as bw
from bandwright.operators.baseline import Baseline
from bandwright.storage import fresh_path
from bandwright.streaming import ingest, ingest_batches, rebuild

AS_OF = "2024-03-05 06:07:08.123456"
SPLIT_BYTES = 4096  # a broadcast budget too small for any of these baselines


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _hundredths(name: str) -> Column:
    return F.round(F.col(name) * 100)


def _value(nan: bool = False) -> Column:
    kept = F.when(F.hour("ts") != 3, _hundredths("value"))
    return F.when(F.hour("ts") == 4, F.lit(float("nan"))).otherwise(kept) if nan else kept


def _readings(spark: SparkSession, sf: str, nan: bool = False) -> DataFrame:
    """Events as readings: sensor = user, no value during hour 3, and NaN during hour 4 if asked for."""
    return _table(spark, sf, "events").select(
        "ts", F.col("user_id").alias("sensor"), "event_id", "event_type", _value(nan).alias("value")
    )


def _context_readings(spark: SparkSession, sf: str) -> DataFrame:
    """Events as readings whose value is always there but whose event type is missing during hour 5."""
    return _table(spark, sf, "events").select(
        "ts",
        F.col("user_id").alias("sensor"),
        "event_id",
        F.when(F.hour("ts") != 5, F.col("event_type")).alias("event_type"),
        _hundredths("value").alias("value"),
    )


def _as_readings(events: DataFrame) -> DataFrame:
    return events.select(
        "ts", F.col("user_id").alias("sensor"), "event_id", "event_type", _hundredths("value").alias("value")
    )


def _raw(spark: SparkSession, sf: str) -> DataFrame:
    return _as_readings(_table(spark, sf, "events"))


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(name, 6) for name in names})


def _stats(df: DataFrame) -> DataFrame:
    return _rounded(df, "avg_value", "stddev_value")


def _anomalies(df: DataFrame) -> DataFrame:
    return _rounded(df, "mean_value", "stddev_value")


# Cleaning, anomalies, rejected rows


def clean_events(spark, sf):
    return bw.clean(_readings(spark, sf), "sensor", "value")


def clean_events_split(spark, sf):
    return bw.clean(_readings(spark, sf), "sensor", "value", broadcast_bytes=SPLIT_BYTES)


def clean_events_window(spark, sf):
    return bw.clean(_readings(spark, sf), "sensor", "value", plan="window")


def anomalies_events_window(spark, sf):
    return _anomalies(bw.detect_anomalies(_readings(spark, sf), "sensor", "value", plan="window"))


def clean_events_nan(spark, sf):
    return bw.clean(_readings(spark, sf, nan=True), "sensor", "value")


def clean_events_context(spark, sf):
    return bw.clean(_context_readings(spark, sf), "sensor", "value")


def clean_events_subset(spark, sf):
    return bw.clean(_context_readings(spark, sf), "sensor", "value", subset=["sensor", "value"])


def clean_lineitem(spark, sf):
    df = _table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return bw.clean(df, "l_orderkey", "l_extendedprice")


def clean_lineitem_keep(spark, sf):
    df = _table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return bw.clean(df, "l_orderkey", "l_extendedprice", on_undefined="keep")


def _taxes(spark: SparkSession, sf: str) -> DataFrame:
    """Few distinct values per order, so that many orders are constant. The root keeps readings from lying at
    exactly two deviations, where the last bit of the deviation would decide."""
    return _table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.sqrt(F.col("l_tax") * 100 + 2).alias("tax")
    )


def clean_lineitem_constant(spark, sf):
    return bw.clean(_taxes(spark, sf), "l_orderkey", "tax")


def anomalies_events(spark, sf):
    return _anomalies(bw.detect_anomalies(_readings(spark, sf), "sensor", "value"))


def anomalies_events_split(spark, sf):
    found = bw.detect_anomalies(_readings(spark, sf), "sensor", "value", broadcast_bytes=SPLIT_BYTES)
    return _anomalies(found)


def anomalies_events_nan(spark, sf):
    return _anomalies(bw.detect_anomalies(_readings(spark, sf, nan=True), "sensor", "value"))


def anomalies_events_context(spark, sf):
    return _anomalies(bw.detect_anomalies(_context_readings(spark, sf), "sensor", "value"))


def anomalies_k3(spark, sf):
    return _anomalies(bw.detect_anomalies(_raw(spark, sf), "sensor", "value", k=3))


def anomalies_k1_5(spark, sf):
    return _anomalies(bw.detect_anomalies(_raw(spark, sf), "sensor", "value", k=1.5))


def _first_half(spark: SparkSession, sf: str) -> Baseline:
    """A baseline from the days before 16 January."""
    return bw.fit_baseline(_raw(spark, sf), "sensor", "value", F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz"))


def anomalies_static_baseline(spark, sf):
    return _anomalies(bw.detect_anomalies(_raw(spark, sf), "sensor", "value", baseline=_first_half(spark, sf)))


def anomalies_static_baseline_split(spark, sf):
    found = bw.detect_anomalies(
        _raw(spark, sf), "sensor", "value", baseline=_first_half(spark, sf), broadcast_bytes=SPLIT_BYTES
    )
    return _anomalies(found)


def anomalies_stored_baseline(spark, sf):
    """The same baseline, stored and read back."""
    path = fresh_path(spark, "baseline")
    bw.store_baseline(_first_half(spark, sf), path)
    found = bw.detect_anomalies(_raw(spark, sf), "sensor", "value", baseline=bw.load_baseline(spark, path, "sensor"))
    return _anomalies(found)


def anomalies_merged_baseline(spark, sf):
    """Baselines of the two halves of the month, merged: as good as one of the whole."""
    later = bw.fit_baseline(_raw(spark, sf), "sensor", "value", F.col("ts") >= F.lit("2024-01-16").cast("timestamp_ntz"))
    merged = bw.merge_baselines(_first_half(spark, sf), later)
    return _anomalies(bw.detect_anomalies(_raw(spark, sf), "sensor", "value", baseline=merged))


def _infinite(spark: SparkSession, sf: str) -> DataFrame:
    """Readings that are infinite during the first minutes of hour 4."""
    broken = (F.hour("ts") == 4) & (F.minute("ts") < 10)
    return _raw(spark, sf).withColumn("value", F.when(broken, F.lit(float("inf"))).otherwise(F.col("value")))


def clean_events_infinite(spark, sf):
    return bw.clean(_infinite(spark, sf), "sensor", "value")


def anomalies_events_infinite(spark, sf):
    return _anomalies(bw.detect_anomalies(_infinite(spark, sf), "sensor", "value"))


def anomalies_documents(spark, sf):
    df = _table(spark, sf, "documents").select("doc_id", "source", "lang", "n_chars")
    return _rounded(bw.detect_anomalies(df, "source", "n_chars", label="chars"), "mean_chars", "stddev_chars")


def anomalies_lineitem_constant(spark, sf):
    return _rounded(bw.detect_anomalies(_taxes(spark, sf), "l_orderkey", "tax"), "mean_tax", "stddev_tax")


def rejected_events(spark, sf):
    return bw.rejected_rows(_readings(spark, sf))


def rejected_events_nan(spark, sf):
    rows = bw.rejected_rows(_readings(spark, sf, nan=True))
    return rows.withColumn("is_nan", F.coalesce(F.isnan("value"), F.lit(False))).drop("value")


def rejected_events_null_only(spark, sf):
    return bw.rejected_rows(_readings(spark, sf, nan=True), nan_is_null=False)


def quality_summary(spark, sf):
    return bw.quality_counts(_readings(spark, sf), "sensor", "value")


def quality_summary_context(spark, sf):
    """With a gap in another column, a reading can be rejected and anomalous at once."""
    return bw.quality_counts(_context_readings(spark, sf), "sensor", "value")


def quality_summary_split(spark, sf):
    return bw.quality_counts(_readings(spark, sf), "sensor", "value", broadcast_bytes=SPLIT_BYTES)


# Statistics, completeness, load columns, expectations


def window_stats_events(spark, sf):
    return _stats(bw.window_stats(clean_events(spark, sf), "sensor", "ts", "value"))


def window_stats_6h(spark, sf):
    return _stats(bw.window_stats(_raw(spark, sf), "sensor", "ts", "value", "6 hours"))


def window_stats_nan(spark, sf):
    return _stats(bw.window_stats(_readings(spark, sf, nan=True), "sensor", "ts", "value"))


def window_stats_7d(spark, sf):
    return _stats(bw.window_stats(_raw(spark, sf), "sensor", "ts", "value", "7 days"))


def window_stats_lineitem(spark, sf):
    df = _table(spark, sf, "lineitem").select("l_suppkey", "l_shipdate", F.col("l_quantity").alias("quantity"))
    stats = bw.window_stats(df, "l_suppkey", "l_shipdate", "quantity", "30 days")
    return _rounded(stats, "avg_quantity", "stddev_quantity")


def completeness_orders(spark, sf):
    df = _table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    return bw.group_completeness(df, "l_orderkey", "l_linenumber", 5, "lines")


def completeness_invalid_orders(spark, sf):
    return bw.incomplete_groups(completeness_orders(spark, sf))


def completeness_sources(spark, sf):
    df = _table(spark, sf, "documents").select("source", "lang")
    return bw.group_completeness(df, "source", "lang", 4, "languages")


def _few_sensors(spark: SparkSession, sf: str) -> DataFrame:
    """Events as readings of five sensors, one of which is silent on every third day."""
    df = _raw(spark, sf).withColumn("sensor", F.col("sensor") % 5).withColumn("day_name", F.date_format("ts", "yyyy-MM-dd"))
    return df.where((F.dayofmonth("ts") % 3 != 0) | (F.col("sensor") != 0))


def completeness_days(spark, sf):
    """Days with all five sensors, and days without one of them."""
    return bw.group_completeness(_few_sensors(spark, sf), "day_name", "sensor", 5, "sensors")


def quality_gate(spark, sf):
    """What the quality gate finds, by kind."""
    spec = bw.ReadingSpec(key="sensor", ts="ts", value="value", group="day_name", expected_keys=5)
    gaps = F.when(F.hour("ts") != 3, F.col("value"))
    report = bw.quality_report(_few_sensors(spark, sf).withColumn("value", gaps), spec)
    kinds = {
        "anomalies": report.anomalies,
        "rejected": report.rejected,
        "complete groups": report.completeness.where("is_valid"),
        "incomplete groups": bw.incomplete_groups(report.completeness),
    }
    return _table_counts(kinds)


def _table_counts(frames: dict[str, DataFrame]) -> DataFrame:
    counted = None
    for name, frame in frames.items():
        one = frame.agg(F.count(F.lit(1)).alias("table_rows")).select(F.lit(name).alias("table_name"), "table_rows")
        counted = one if counted is None else counted.unionByName(one)
    return counted


def load_columns_events(spark, sf):
    stamped = bw.with_load_columns(_table(spark, sf, "events").select("event_id", "value"), AS_OF)
    return stamped.withColumn("insert_timestamp", F.col("insert_timestamp").cast("timestamp_ntz"))


RULES = {
    "valid_ts": "ts > timestamp_ntz'2024-01-08'",
    "has_value": "value IS NOT NULL",
    "small_value": "value < 10000",
}


def expectation_counts(spark, sf):
    return bw.expectation_counts(_readings(spark, sf), RULES)


# Sources and sinks. Targets are fresh folders below the shared checkpoint folder.

READING_COLUMNS = "ts TIMESTAMP_NTZ, sensor BIGINT, event_id BIGINT, event_type STRING, value DOUBLE"
STORED_COLUMNS = READING_COLUMNS + ", insert_timestamp TIMESTAMP, year INT, month INT, day INT"


def _roundtrip(spark: SparkSession, sf: str, fmt: str) -> DataFrame:
    contract = bw.DatasetContract("cleaned", STORED_COLUMNS, fmt, {"path": fresh_path(spark, f"{fmt}-roundtrip")})
    bw.write_contract(contract.conform(bw.with_load_columns(clean_events(spark, sf), AS_OF)), contract)
    stored = bw.read_contract(spark, contract)
    return stored.withColumn("insert_timestamp", F.col("insert_timestamp").cast("timestamp_ntz"))


def csv_roundtrip(spark, sf):
    return _roundtrip(spark, sf, "csv")


def parquet_roundtrip(spark, sf):
    return _roundtrip(spark, sf, "parquet")


def save_modes(spark, sf):
    """Rows of a dataset after writes in each mode."""
    rows, frames = _raw(spark, sf), {}
    contract = {
        mode: bw.DatasetContract(mode, READING_COLUMNS, "parquet", {"path": fresh_path(spark, mode)}, ())
        for mode in ("append", "overwrite", "ignore", "error")
    }
    for mode, target in contract.items():
        bw.write_contract(rows.where("sensor % 2 = 0"), target, "error")
        try:
            bw.write_contract(rows, target, mode)
        except AnalysisException as problem:
            if mode != "error":
                raise
            assert problem.getCondition() == "PATH_ALREADY_EXISTS"
        frames[mode] = bw.read_contract(spark, target)
    return _table_counts(frames)


def _csv_files(spark: SparkSession, df: DataFrame, by_day: bool = False) -> str:
    """Readings as CSV files with a header, as they would arrive; with `by_day` in one folder per day."""
    path = fresh_path(spark, "arrived")
    writer = (df.withColumn("on", F.to_date("ts")) if by_day else df).write
    writer = writer.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    (writer.partitionBy("on") if by_day else writer).csv(path)
    return path


def csv_scan_rejected(spark, sf):
    """Readings whose text does not parse ("n/a" during hour 3) come back as NULL and are rejected."""
    as_text = _readings(spark, sf).withColumn("value", F.coalesce(F.col("value").cast("string"), F.lit("n/a")))
    df = bw.read_csv(spark, _csv_files(spark, as_text), READING_COLUMNS)
    return bw.rejected_rows(df).drop("filename")


def csv_folder_completeness(spark, sf):
    """Distinct event types per day folder, from the lineage column."""
    df = bw.read_csv(spark, _csv_files(spark, _raw(spark, sf), by_day=True), READING_COLUMNS)
    days = df.withColumn("folder", F.regexp_extract("filename", "on=([0-9-]+)", 1))
    return bw.group_completeness(days, "folder", "sensor", 150, "sensors")


# The batch flow: CSV in, four outputs and the completeness check

SPEC = bw.ReadingSpec(key="sensor", ts="ts", value="value", schema=READING_COLUMNS, expected_keys=150)


def _run(spark: SparkSession, sf: str) -> bw.Outputs:
    return bw.run_batch(spark, _csv_files(spark, _readings(spark, sf)), SPEC, as_of=AS_OF, storage_level=None)


def _stamped(df: DataFrame) -> DataFrame:
    return df.withColumn("insert_timestamp", F.col("insert_timestamp").cast("timestamp_ntz")).drop("filename")


def batch_cleaned(spark, sf):
    return _stamped(_run(spark, sf).cleaned)


def batch_stats(spark, sf):
    return _stats(_stamped(_run(spark, sf).stats))


def batch_anomalies(spark, sf):
    return _anomalies(_stamped(_run(spark, sf).anomalies))


def batch_rejected(spark, sf):
    return _stamped(_run(spark, sf).rejected)


def _contracts(spark: SparkSession) -> dict[str, bw.DatasetContract]:
    columns = {
        "cleaned": STORED_COLUMNS,
        "stats": "sensor BIGINT, start TIMESTAMP_NTZ, end TIMESTAMP_NTZ, min_value DOUBLE, max_value DOUBLE, "
        "avg_value DOUBLE, stddev_value DOUBLE, year INT, month INT, day INT, insert_timestamp TIMESTAMP",
        "anomalies": "ts TIMESTAMP_NTZ, sensor BIGINT, value DOUBLE, mean_value DOUBLE, stddev_value DOUBLE, "
        "event_type STRING, event_id BIGINT, year INT, month INT, day INT, insert_timestamp TIMESTAMP",
        "rejected": STORED_COLUMNS,
    }
    formats = {"cleaned": "parquet", "stats": "parquet", "anomalies": "csv", "rejected": "csv"}
    root = fresh_path(spark, "batch")
    return {
        name: bw.DatasetContract(name, columns[name], formats[name], {"path": f"{root}/{name}"}) for name in columns
    }


def batch_written(spark, sf):
    """All four outputs written under their contracts; anomalies read back."""
    contracts, source = _contracts(spark), _csv_files(spark, _readings(spark, sf))
    with bw.run_batch(spark, source, SPEC, as_of=AS_OF) as outputs:
        bw.write_outputs(outputs, contracts)
    return _anomalies(_stamped(bw.read_contract(spark, contracts["anomalies"])))


def _written(spark: SparkSession, sf: str, name: str) -> DataFrame:
    contracts, source = _contracts(spark), _csv_files(spark, _readings(spark, sf))
    with bw.run_batch(spark, source, SPEC, as_of=AS_OF) as outputs:
        bw.write_outputs(outputs, contracts)
    return _stamped(bw.read_contract(spark, contracts[name]))


def batch_written_cleaned(spark, sf):
    return _written(spark, sf, "cleaned")


def batch_written_stats(spark, sf):
    return _stats(_written(spark, sf, "stats"))


def batch_written_rejected(spark, sf):
    return _written(spark, sf, "rejected")


def batch_rerun(spark, sf):
    """Rows of each output after the same run was written twice, and another one once."""
    contracts, source = _contracts(spark), _csv_files(spark, _readings(spark, sf))
    with bw.run_batch(spark, source, SPEC, as_of=AS_OF) as outputs:
        for run_id in ("first", "second", "first"):
            bw.write_outputs(outputs, contracts, run_id=run_id)
    return _table_counts({name: bw.read_contract(spark, contract) for name, contract in contracts.items()})


# Streaming


def _event_stream(spark: SparkSession, sf: str) -> DataFrame:
    schema = _table(spark, sf, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    return _as_readings(stream)


def _ntz(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in names})


def stream_stats_closed(spark, sf):
    """Window statistics of a stream: the windows that the watermark has closed."""
    root = fresh_path(spark, "stream-stats")
    bw.write_window_stats(
        _event_stream(spark, sf), "sensor", "ts", "value", watermark="1 hour", path=f"{root}/stats",
        checkpoint=f"{root}/checkpoint",
    ).awaitTermination()
    return _stats(_ntz(spark.read.parquet(f"{root}/stats"), "start", "end"))


def stream_static_anomalies(spark, sf):
    """A stream judged by a stored baseline."""
    root = fresh_path(spark, "stream-anomalies")
    found = bw.detect_anomalies(_event_stream(spark, sf), "sensor", "value", baseline=_first_half(spark, sf))
    query = found.writeStream.format("parquet").option("path", f"{root}/anomalies")
    query.option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return _anomalies(spark.read.parquet(f"{root}/anomalies"))


def stream_completeness(spark, sf):
    """Distinct sensors per day and event type of a stream: the days that the watermark has closed."""
    root = fresh_path(spark, "stream-completeness")
    schema = _table(spark, sf, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    sensors = _as_readings(stream).withColumn("sensor", F.col("sensor") % 5)
    sensors = sensors.where((F.dayofmonth("ts") % 3 != 0) | (F.col("sensor") != 0)).withColumn("plant", F.lit("one"))
    bw.write_stream_completeness(
        sensors, "plant", "sensor", "ts", 5, count_name="sensors", path=f"{root}/judged", checkpoint=f"{root}/checkpoint"
    ).awaitTermination()
    return _ntz(spark.read.parquet(f"{root}/judged"), "start", "end")


def stream_batch_outputs(spark, sf):
    """Each micro-batch judged by its own readings; here the backlog is one micro-batch."""
    lake = bw.Lake(fresh_path(spark, "lake-batch"))
    source = _csv_files(spark, _readings(spark, sf))
    ingest_batches(bw.stream_csv(spark, source, READING_COLUMNS), lake, SPEC)
    found = lake.read(spark, "anomalies").select(
        "ts", "sensor", "event_id", "event_type", "value", "mean_value", "stddev_value"
    )
    return _anomalies(found)


GRAPH = ("bronze", "cleaned", "stats", "anomalies", "rejected")


def _graph(spark: SparkSession, sf: str) -> bw.Lake:
    lake = bw.Lake(fresh_path(spark, "lake-history"))
    source = _csv_files(spark, _readings(spark, sf))
    ingest(bw.stream_csv(spark, source, READING_COLUMNS), lake)
    rebuild(spark, lake, SPEC)
    return lake


def graph_stats(spark, sf):
    """Streaming ingest to bronze, everything else recomputed from it; the statistics table."""
    return _stats(_graph(spark, sf).read(spark, "stats").drop("insert_timestamp", "year", "month", "day"))


def graph_counts(spark, sf):
    """Rows of every table of the graph."""
    lake = _graph(spark, sf)
    return _table_counts({name: lake.read(spark, name) for name in GRAPH})


def graph_counts_clean(spark, sf):
    """The same with nothing wrong: every sensor reads its own number, always. Two tables are empty."""
    lake = bw.Lake(fresh_path(spark, "lake-clean"))
    steady = _raw(spark, sf).withColumn("value", F.col("sensor").cast("double"))
    bw.run_incremental(spark, _csv_files(spark, steady), lake, SPEC)
    return _table_counts({name: lake.read(spark, name) for name in GRAPH})


def _two_arrivals(spark: SparkSession, sf: str, lake: bw.Lake, **options) -> None:
    """The first half of the month is ingested and judged, then the second half."""
    source = fresh_path(spark, "arrivals")
    for part, days in (("a", F.dayofmonth("ts") < 16), ("b", F.dayofmonth("ts") >= 16)):
        writer = _readings(spark, sf).where(days).write.option("header", True)
        writer.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").csv(f"{source}/{part}")
        bw.run_incremental(spark, source, lake, SPEC, recursiveFileLookup=True, **options)


def graph_merged_history(spark, sf):
    """Anomalies after two arrivals: the statistics of the second are merged into those of the first."""
    lake = bw.Lake(fresh_path(spark, "lake-merged"))
    _two_arrivals(spark, sf, lake)
    found = lake.read(spark, "anomalies").select(
        "ts", "sensor", "event_id", "event_type", "value", "mean_value", "stddev_value"
    )
    return _anomalies(found)


def graph_ledger(spark, sf):
    """Violations of both arrivals, from the ledger."""
    lake = bw.Lake(fresh_path(spark, "lake-ledger"))
    _two_arrivals(spark, sf, lake, rules=RULES)
    return lake.ledger(spark).groupBy("rule").agg(F.sum("violations").alias("violations"))


def graph_completeness(spark, sf):
    """Stored completeness per day, in a lake that was built in two arrivals."""
    lake, source = bw.Lake(fresh_path(spark, "lake-days")), fresh_path(spark, "arrivals")
    spec = bw.ReadingSpec(
        key="sensor", ts="ts", value="value", group="day_name", expected_keys=5, count_name="sensors",
        schema=READING_COLUMNS + ", day_name STRING",
    )
    for part, days in (("a", F.dayofmonth("ts") < 16), ("b", F.dayofmonth("ts") >= 16)):
        writer = _few_sensors(spark, sf).where(days).write.option("header", True)
        writer.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").csv(f"{source}/{part}")
        stream = bw.stream_csv(spark, source, spec.schema, file_column=None, recursiveFileLookup=True)
        ingest(stream, lake)
        rebuild(spark, lake, spec)
    return lake.read(spark, "completeness").select("day_name", "sensors", "is_valid")


def graph_named_tables(spark, sf):
    """Rows of the named tables of the graph after two arrivals."""
    root = fresh_path(spark, "lake-named")
    database = "graph_" + root.rsplit("-", 1)[-1]
    spark.sql(f"CREATE DATABASE {database} LOCATION '{root}/_database'")
    _two_arrivals(spark, sf, bw.Lake(root, database=database))
    return _table_counts({name: bw.read_table(spark, f"{database}.{name}") for name in GRAPH})


def graph_expectations(spark, sf):
    """Violations counted on the way into bronze."""
    lake = bw.Lake(fresh_path(spark, "lake-rules"))
    counts = bw.run_incremental(spark, _csv_files(spark, _readings(spark, sf)), lake, SPEC, rules=RULES)
    return spark.createDataFrame(sorted(counts.items()), "rule STRING, violations LONG")


def batch_expectations(spark, sf):
    """The same in the scope of each micro-batch."""
    lake = bw.Lake(fresh_path(spark, "lake-batch-rules"))
    source = _csv_files(spark, _readings(spark, sf))
    counts = bw.run_incremental(spark, source, lake, SPEC, scope="batch", rules=RULES)
    return spark.createDataFrame(sorted(counts.items()), "rule STRING, violations LONG")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        clean_events,
        clean_events_split,
        clean_events_window,
        anomalies_events_window,
        clean_events_nan,
        clean_events_context,
        clean_events_subset,
        clean_lineitem,
        clean_lineitem_keep,
        clean_lineitem_constant,
        anomalies_events,
        anomalies_events_split,
        anomalies_events_nan,
        anomalies_events_context,
        anomalies_k3,
        anomalies_k1_5,
        anomalies_static_baseline,
        anomalies_static_baseline_split,
        anomalies_stored_baseline,
        anomalies_merged_baseline,
        clean_events_infinite,
        anomalies_events_infinite,
        anomalies_documents,
        anomalies_lineitem_constant,
        rejected_events,
        rejected_events_nan,
        rejected_events_null_only,
        quality_summary,
        quality_summary_context,
        quality_summary_split,
        window_stats_events,
        window_stats_6h,
        window_stats_nan,
        window_stats_7d,
        window_stats_lineitem,
        completeness_orders,
        completeness_invalid_orders,
        completeness_sources,
        completeness_days,
        quality_gate,
        save_modes,
        load_columns_events,
        expectation_counts,
        csv_roundtrip,
        parquet_roundtrip,
        csv_scan_rejected,
        csv_folder_completeness,
        batch_cleaned,
        batch_stats,
        batch_anomalies,
        batch_rejected,
        batch_written,
        batch_written_cleaned,
        batch_written_stats,
        batch_written_rejected,
        batch_rerun,
        stream_stats_closed,
        stream_completeness,
        stream_static_anomalies,
        stream_batch_outputs,
        graph_stats,
        graph_counts,
        graph_counts_clean,
        graph_merged_history,
        graph_ledger,
        graph_completeness,
        graph_named_tables,
        graph_expectations,
        batch_expectations,
    )
}


# The same questions in SQL

_RAW = "SELECT ts, user_id AS sensor, event_id, event_type, round(value * 100) AS value FROM events"
_INJECTED = (
    "SELECT ts, user_id AS sensor, event_id, event_type,"
    " CASE WHEN extract(hour FROM ts) <> 3 THEN round(value * 100) END AS value FROM events"
)
_WITHOUT_3_AND_4 = (
    "SELECT ts, user_id AS sensor, event_id, event_type,"
    " CASE WHEN extract(hour FROM ts) NOT IN (3, 4) THEN round(value * 100) END AS value FROM events"
)
_CONTEXT = (
    "SELECT ts, user_id AS sensor, event_id,"
    " CASE WHEN extract(hour FROM ts) <> 5 THEN event_type END AS event_type, round(value * 100) AS value FROM events"
)
_MAY_BREAK = f"SELECT *, extract(hour FROM ts) = 4 AND extract(minute FROM ts) < 10 AS broken FROM ({_RAW})"
_FINITE = f"SELECT ts, sensor, event_id, event_type, CASE WHEN NOT broken THEN value END AS value FROM ({_MAY_BREAK})"
_STEADY = "SELECT ts, user_id AS sensor, event_id, event_type, user_id::DOUBLE AS value FROM events"
_VIOLATIONS = f"""
SELECT unnest(['rows', 'valid_ts', 'has_value', 'small_value']) AS rule, unnest([count(*),
  count(*) FILTER (WHERE NOT coalesce(ts > TIMESTAMP '2024-01-08', false)),
  count(*) FILTER (WHERE value IS NULL),
  count(*) FILTER (WHERE NOT coalesce(value < 10000, false))]) AS violations
FROM ({_INJECTED})"""
_EVENT_COLUMNS = "x.ts, x.sensor, x.event_id, x.event_type, x.value"


def _sql_clean(
    source: str, key: str = "sensor", value: str = "value", columns: str = _EVENT_COLUMNS, complete: str = "",
    undefined: str = "",
) -> str:
    complete = complete or f"{value} IS NOT NULL"
    return f"""
WITH x AS (SELECT * FROM ({source}) WHERE {complete}),
s AS (SELECT {key} AS k, avg({value}) AS m, stddev_samp({value}) AS sd FROM x GROUP BY 1)
SELECT {columns} FROM x JOIN s ON x.{key} = s.k
WHERE (x.{value} <= s.m + 2 * s.sd AND x.{value} >= s.m - 2 * s.sd) OR s.sd = 0 {undefined}"""


def _sql_anomalies(
    source: str, k: float = 2, key: str = "sensor", value: str = "value", columns: str = _EVENT_COLUMNS,
    label: str = "value", history: str = "",
) -> str:
    return f"""
WITH x AS ({source}),
s AS (SELECT {key} AS k, avg({value}) AS m, stddev_samp({value}) AS sd FROM x {history} GROUP BY 1)
SELECT {columns}, round(s.m, 6) AS mean_{label}, round(s.sd, 6) AS stddev_{label}
FROM x JOIN s ON x.{key} = s.k
WHERE s.sd > 0 AND (x.{value} > s.m + {k} * s.sd OR x.{value} < s.m - {k} * s.sd)"""


def _sql_stats(
    source: str, duration: str = "24 hours", key: str = "sensor", ts: str = "ts", value: str = "value",
    label: str = "value", extra: str = "", having: str = "",
) -> str:
    bucket = f"time_bucket(INTERVAL '{duration}', {ts}, TIMESTAMP '1970-01-01')"
    return f"""
WITH w AS (SELECT {key}, {ts}, {value}, {bucket} AS "start" FROM ({source}))
SELECT {key}, "start", "start" + INTERVAL '{duration}' AS "end",
  min({value}) AS min_{label}, max({value}) AS max_{label},
  round(avg({value}), 6) AS avg_{label}, round(stddev_samp({value}), 6) AS stddev_{label}{extra}
FROM w GROUP BY {key}, "start" {having}"""


_LOAD = (
    f", TIMESTAMP '{AS_OF}' AS insert_timestamp, CAST(2024 AS INTEGER) AS year,"
    " CAST(3 AS INTEGER) AS month, CAST(5 AS INTEGER) AS day"
)
_CLEANED = _sql_clean(_INJECTED)
_FOUND = _sql_anomalies(_INJECTED)
_REJECTED = f"SELECT * FROM ({_INJECTED}) WHERE value IS NULL"
_SUMMARY = f"""
SELECT 'cleaned' AS outcome, count(*) AS readings FROM ({_CLEANED})
UNION ALL SELECT 'anomalies', count(*) FROM ({_FOUND})
UNION ALL SELECT 'rejected', count(*) FROM ({_REJECTED})
UNION ALL SELECT 'total', count(*) FROM events"""
_LINES = "SELECT l_orderkey, l_linenumber, {} FROM lineitem"
_LINE_COLUMNS = "x.l_orderkey, x.l_linenumber, x.{}"
_FEW = (
    "SELECT ts, user_id % 5 AS sensor, event_id, event_type, round(value * 100) AS value,"
    " strftime(ts, '%Y-%m-%d') AS day_name FROM events WHERE day(ts) % 3 <> 0 OR user_id % 5 <> 0"
)
_FEW_GAPS = f"SELECT * REPLACE (CASE WHEN extract(hour FROM ts) <> 3 THEN value END AS value) FROM ({_FEW})"
_DAYS = f"SELECT day_name, count(DISTINCT sensor) AS sensors, count(DISTINCT sensor) = 5 AS is_valid FROM ({_FEW}) GROUP BY 1"
_HISTORY = "WHERE ts < TIMESTAMP '2024-01-16'"
_ORDERS = (
    "SELECT l_orderkey, count(DISTINCT l_linenumber) AS lines, count(DISTINCT l_linenumber) = 5 AS is_valid"
    " FROM lineitem GROUP BY 1"
)

ORACLE: dict[str, str] = {
    "clean_events": _CLEANED,
    "clean_events_split": _CLEANED,
    "clean_events_nan": _sql_clean(_WITHOUT_3_AND_4),
    "clean_events_context": _sql_clean(_CONTEXT, complete="event_type IS NOT NULL"),
    "clean_events_subset": _sql_clean(_CONTEXT),
    "clean_lineitem": _sql_clean(
        _LINES.format("l_extendedprice"), "l_orderkey", "l_extendedprice", _LINE_COLUMNS.format("l_extendedprice")
    ),
    "clean_lineitem_keep": _sql_clean(
        _LINES.format("l_extendedprice"), "l_orderkey", "l_extendedprice", _LINE_COLUMNS.format("l_extendedprice"),
        undefined="OR s.sd IS NULL",
    ),
    "clean_lineitem_constant": _sql_clean(
        _LINES.format("sqrt(l_tax * 100 + 2) AS tax"), "l_orderkey", "tax", _LINE_COLUMNS.format("tax")
    ),
    "anomalies_events": _FOUND,
    "anomalies_events_split": _FOUND,
    "anomalies_events_nan": _sql_anomalies(_WITHOUT_3_AND_4),
    "anomalies_events_context": _sql_anomalies(_CONTEXT),
    "anomalies_k3": _sql_anomalies(_RAW, 3),
    "anomalies_k1_5": _sql_anomalies(_RAW, 1.5),
    "anomalies_static_baseline": _sql_anomalies(_RAW, history=_HISTORY),
    "anomalies_static_baseline_split": _sql_anomalies(_RAW, history=_HISTORY),
    "anomalies_stored_baseline": _sql_anomalies(_RAW, history=_HISTORY),
    "anomalies_merged_baseline": _sql_anomalies(_RAW),
    "clean_events_infinite": _sql_clean(_FINITE),
    "anomalies_events_infinite": f"""
WITH f AS ({_FINITE}), s AS (SELECT sensor AS k, avg(value) AS m, stddev_samp(value) AS sd FROM f GROUP BY 1)
SELECT x.ts, x.sensor, x.event_id, x.event_type,
  CASE WHEN x.broken THEN 'Infinity'::DOUBLE ELSE x.value END AS value,
  round(s.m, 6) AS mean_value, round(s.sd, 6) AS stddev_value
FROM ({_MAY_BREAK}) x LEFT JOIN s ON x.sensor = s.k
WHERE x.broken OR (s.sd > 0 AND (x.value > s.m + 2 * s.sd OR x.value < s.m - 2 * s.sd))""",
    "anomalies_documents": _sql_anomalies(
        "SELECT doc_id, source, lang, n_chars FROM documents", 2, "source", "n_chars",
        "x.doc_id, x.source, x.lang, x.n_chars", "chars",
    ),
    "anomalies_lineitem_constant": _sql_anomalies(
        _LINES.format("sqrt(l_tax * 100 + 2) AS tax"), 2, "l_orderkey", "tax", _LINE_COLUMNS.format("tax"), "tax"
    ),
    "rejected_events": _REJECTED,
    "rejected_events_nan": (
        "SELECT ts, user_id AS sensor, event_id, event_type, extract(hour FROM ts) = 4 AS is_nan"
        " FROM events WHERE extract(hour FROM ts) IN (3, 4)"
    ),
    "rejected_events_null_only": _REJECTED,
    "quality_summary": _SUMMARY,
    "quality_summary_split": _SUMMARY,
    "quality_summary_context": f"""
SELECT 'cleaned' AS outcome, count(*) AS readings FROM ({_sql_clean(_CONTEXT, complete="event_type IS NOT NULL")})
UNION ALL SELECT 'anomalies', count(*) FROM ({_sql_anomalies(_CONTEXT)})
UNION ALL SELECT 'rejected', count(*) FROM ({_CONTEXT}) WHERE event_type IS NULL
UNION ALL SELECT 'total', count(*) FROM events""",
    "window_stats_events": _sql_stats(_CLEANED),
    "window_stats_6h": _sql_stats(_RAW, "6 hours"),
    "window_stats_nan": _sql_stats(_WITHOUT_3_AND_4),
    "window_stats_7d": _sql_stats(_RAW, "7 days"),
    "window_stats_lineitem": _sql_stats(
        "SELECT l_suppkey, l_shipdate, l_quantity AS quantity FROM lineitem",
        "30 days", "l_suppkey", "l_shipdate", "quantity", "quantity",
    ),
    "completeness_orders": _ORDERS,
    "completeness_invalid_orders": f"SELECT * FROM ({_ORDERS}) WHERE NOT is_valid",
    "completeness_sources": (
        "SELECT source, count(DISTINCT lang) AS languages, count(DISTINCT lang) = 4 AS is_valid"
        " FROM documents GROUP BY 1"
    ),
    "completeness_days": _DAYS,
    "graph_completeness": _DAYS,
    "quality_gate": f"""
SELECT 'anomalies' AS table_name, count(*) AS table_rows FROM ({_sql_anomalies(_FEW_GAPS)})
UNION ALL SELECT 'rejected', count(*) FROM ({_FEW_GAPS}) WHERE value IS NULL
UNION ALL SELECT 'complete groups', count(*) FROM ({_DAYS}) WHERE is_valid
UNION ALL SELECT 'incomplete groups', count(*) FROM ({_DAYS}) WHERE NOT is_valid""",
    "save_modes": """
WITH n AS (SELECT count(*) AS whole, count(*) FILTER (WHERE user_id % 2 = 0) AS half FROM events)
SELECT unnest(['append', 'overwrite', 'ignore', 'error']) AS table_name,
  unnest([whole + half, whole, half, half]) AS table_rows FROM n""",
    "clean_events_window": _CLEANED,
    "anomalies_events_window": _FOUND,
    "load_columns_events": f"SELECT event_id, value{_LOAD} FROM events",
    "expectation_counts": f"""
SELECT count(*) AS rows,
  count(*) FILTER (WHERE NOT coalesce(ts > TIMESTAMP '2024-01-08', false)) AS valid_ts,
  count(*) FILTER (WHERE value IS NULL) AS has_value,
  count(*) FILTER (WHERE NOT coalesce(value < 10000, false)) AS small_value
FROM ({_INJECTED})""",
    "csv_roundtrip": f"SELECT *{_LOAD} FROM ({_CLEANED})",
    "parquet_roundtrip": f"SELECT *{_LOAD} FROM ({_CLEANED})",
    "csv_scan_rejected": _REJECTED,
    "csv_folder_completeness": (
        "SELECT strftime(ts, '%Y-%m-%d') AS folder, count(DISTINCT user_id) AS sensors,"
        " count(DISTINCT user_id) = 150 AS is_valid FROM events GROUP BY 1"
    ),
    "batch_cleaned": f"SELECT *{_LOAD} FROM ({_CLEANED})",
    "batch_stats": _sql_stats(_CLEANED, extra=_LOAD),
    "batch_anomalies": f"SELECT *{_LOAD} FROM ({_FOUND})",
    "batch_rejected": f"SELECT *{_LOAD} FROM ({_REJECTED})",
    "batch_written": f"SELECT *{_LOAD} FROM ({_FOUND})",
    "batch_written_cleaned": f"SELECT *{_LOAD} FROM ({_CLEANED})",
    "batch_written_stats": _sql_stats(_CLEANED, extra=_LOAD),
    "batch_written_rejected": f"SELECT *{_LOAD} FROM ({_REJECTED})",
    "batch_rerun": f"""
SELECT 'cleaned' AS table_name, 2 * count(*) AS table_rows FROM ({_CLEANED})
UNION ALL SELECT 'stats', 2 * count(*) FROM ({_sql_stats(_CLEANED)})
UNION ALL SELECT 'anomalies', 2 * count(*) FROM ({_FOUND})
UNION ALL SELECT 'rejected', 2 * count(*) FROM ({_REJECTED})""",
    "stream_completeness": f"""
WITH d AS (SELECT time_bucket(INTERVAL '24 hours', ts, TIMESTAMP '1970-01-01') AS "start", sensor FROM ({_FEW}))
SELECT 'one' AS plant, "start", "start" + INTERVAL '24 hours' AS "end", count(DISTINCT sensor) AS sensors,
  count(DISTINCT sensor) = 5 AS is_valid FROM d GROUP BY "start"
HAVING "start" + INTERVAL '24 hours' <= (SELECT max(ts) FROM ({_FEW})) - INTERVAL '1 hour'""",
    "stream_stats_closed": _sql_stats(
        _RAW, having="""HAVING "start" + INTERVAL '24 hours' <= (SELECT max(ts) FROM events) - INTERVAL '1 hour'"""
    ),
    "stream_static_anomalies": _sql_anomalies(_RAW, history=_HISTORY),
    "stream_batch_outputs": _FOUND,
    "graph_stats": _sql_stats(_CLEANED),
    "graph_merged_history": _FOUND,
    "graph_ledger": _VIOLATIONS,
    "graph_counts": f"""
SELECT 'bronze' AS table_name, count(*) AS table_rows FROM events
UNION ALL SELECT 'cleaned', count(*) FROM ({_CLEANED})
UNION ALL SELECT 'stats', count(*) FROM ({_sql_stats(_CLEANED)})
UNION ALL SELECT 'anomalies', count(*) FROM ({_FOUND})
UNION ALL SELECT 'rejected', count(*) FROM ({_REJECTED})""",
    "graph_counts_clean": f"""
SELECT 'bronze' AS table_name, count(*) AS table_rows FROM events
UNION ALL SELECT 'cleaned', count(*) FROM ({_sql_clean(_STEADY)})
UNION ALL SELECT 'stats', count(*) FROM ({_sql_stats(_sql_clean(_STEADY))})
UNION ALL SELECT 'anomalies', 0
UNION ALL SELECT 'rejected', 0""",
    "graph_expectations": _VIOLATIONS,
    "batch_expectations": _VIOLATIONS,
}
ORACLE["graph_named_tables"] = ORACLE["graph_counts"]
