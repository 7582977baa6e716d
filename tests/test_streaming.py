import os

import pytest
from conftest import five_turbines
from pyspark.sql import functions as F

import bandwright as bw
from bandwright import presets
from bandwright.streaming import ingest, write_batch

SPEC = presets.wind_power_spec()
TABLES = ("bronze", "cleaned", "stats", "anomalies", "rejected")
OUTLIER = [f"2022-03-01T1{i}:00:00,1,11.0,169,101.5" for i in range(8)] + [
    "2022-03-01T19:00:00,1,11.0,169,9999.0",
    "2022-03-01T20:00:00,2,11.0,169,",
]


def counts(spark, lake):
    return {name: lake.read(spark, name).count() for name in TABLES}


def test_history_scope(spark, tmp_path):
    lake = bw.Lake(str(tmp_path / "lake"))
    source = five_turbines(tmp_path / "in", files=2, broken=OUTLIER)
    seen = bw.run_incremental(spark, source, lake, SPEC, rules=presets.VALID_TIMESTAMP)
    assert seen == {"rows": 60, "valid timestamp": 0}
    first = counts(spark, lake)
    assert first == {"bronze": 60, "cleaned": 56, "stats": 10, "anomalies": 2, "rejected": 2}
    bronze = lake.read(spark, "bronze")
    assert {"filename", "insert_timestamp", "year", "month", "day"} <= set(bronze.columns)
    assert bronze.where("filename IS NULL").count() == 0

    # Nothing new: nothing changes, and the files are not read twice.
    assert bw.run_incremental(spark, source, lake, SPEC, rules=presets.VALID_TIMESTAMP).get("rows", 0) == 0
    assert counts(spark, lake) == first

    # A third file is judged together with the first two.
    five_turbines(tmp_path / "in", files=3)
    old = "2011-01-01T00:00:00,3,11.0,169,103.5"
    (tmp_path / "in" / "late.csv").write_text("timestamp,turbine_id,wind_speed,wind_direction,power_output\n" + old)
    seen = bw.run_incremental(spark, source, lake, SPEC, rules=presets.VALID_TIMESTAMP)
    assert seen["valid timestamp"] == 1
    assert lake.read(spark, "bronze").count() == 60 + seen["rows"]
    batch = bw.run_batch(spark, lake.read(spark, "bronze").drop("insert_timestamp", "year", "month", "day"), SPEC)
    with batch:
        for name in ("cleaned", "stats", "anomalies", "rejected"):
            columns = [c for c in getattr(batch, name).columns if c not in bw.functions.LOAD_COLUMNS]
            stored, direct = (df.select(columns) for df in (lake.read(spark, name), getattr(batch, name)))
            assert stored.exceptAll(direct).count() == 0 and direct.exceptAll(stored).count() == 0


@pytest.mark.parametrize("scope", ["history", "batch"])
def test_nothing_has_arrived_yet(spark, tmp_path, scope):
    (tmp_path / "in").mkdir()
    lake = bw.Lake(str(tmp_path / "lake"))
    assert bw.run_incremental(spark, str(tmp_path / "in"), lake, SPEC, scope=scope) == {}
    source = five_turbines(tmp_path / "in")
    bw.run_incremental(spark, source, lake, SPEC, scope=scope)
    assert lake.read(spark, "cleaned").count() == 20


def test_named_tables(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS graph")
    lake = bw.Lake(str(tmp_path / "lake"), database="graph")
    source = five_turbines(tmp_path / "in", broken=OUTLIER)
    for _ in range(2):
        bw.run_incremental(spark, source, lake, SPEC)
    for name in TABLES:
        table = f"graph.{name}"
        assert bw.read_table(spark, table).count() == lake.read(spark, name).count() > 0
        described = spark.sql(f"DESCRIBE EXTENDED {table}").collect()
        about = {r.col_name: r.data_type for r in described}
        assert about["Comment"] == lake.comments[name]
        assert "# col_name" in about, (name, about)
        start = [r.col_name for r in described].index("# col_name") + 1
        assert [r.col_name for r in described[start : start + 3]] == ["year", "month", "day"]
    spark.sql("DROP DATABASE graph CASCADE")


def test_batch_scope_judges_each_batch_alone(spark, tmp_path):
    lake = bw.Lake(str(tmp_path / "lake"))
    source = five_turbines(tmp_path / "in", files=2, broken=OUTLIER)
    bw.run_incremental(spark, source, lake, SPEC, scope="batch", maxFilesPerTrigger=1)
    # One window is in both files and is summed up in each batch: 11 rows, not 10.
    assert counts(spark, lake) == {"bronze": 60, "cleaned": 56, "stats": 11, "anomalies": 2, "rejected": 2}
    assert [r.batch_id for r in lake.read(spark, "cleaned").select("batch_id").distinct().sort("batch_id").collect()] == [0, 1]
    bw.run_incremental(spark, source, lake, SPEC, scope="batch", maxFilesPerTrigger=1)
    assert lake.read(spark, "bronze").count() == 60
    with pytest.raises(ValueError, match="scope"):
        bw.run_incremental(spark, source, lake, SPEC, scope="everything")


def test_replayed_batch_replaces_its_rows(spark, tmp_path):
    lake = bw.Lake(str(tmp_path / "lake"))
    batch = bw.read_csv(spark, five_turbines(tmp_path / "in", broken=OUTLIER), SPEC.schema)
    write_batch(batch, 7, lake, SPEC)
    write_batch(batch, 8, lake, SPEC)
    once = counts(spark, lake)
    write_batch(batch, 8, lake, SPEC)
    assert counts(spark, lake) == once


def _event_files(spark, sf, path, parts=1):
    df = spark.read.parquet(f"{sf}/events.parquet")
    df.repartitionByRange(parts, "ts").sortWithinPartitions("ts").write.parquet(str(path))
    return df, spark.readStream.schema(df.schema).parquet(str(path))


def test_closed_windows_equal_batch_and_restart_adds_nothing(spark, sf, tmp_path):
    df, stream = _event_files(spark, sf, tmp_path / "in")
    for _ in range(2):
        bw.write_window_stats(
            stream, "user_id", "ts", "value", watermark="1 hour", path=str(tmp_path / "out"),
            checkpoint=str(tmp_path / "checkpoint"),
        ).awaitTermination()
    stored = spark.read.parquet(str(tmp_path / "out"))
    whole = bw.window_stats(df.withColumn("ts", F.col("ts").cast("timestamp")), "user_id", "ts", "value")
    last = df.agg(F.max(F.col("ts").cast("timestamp"))).first()[0]
    closed = whole.where(F.col("end") <= F.lit(last) - F.expr("INTERVAL 1 HOUR"))
    keys = ("user_id", "start", "end", "min_value", "max_value")
    assert 0 < closed.count() < whole.count()
    assert stored.select(*keys).exceptAll(closed.select(*keys)).count() == 0
    assert closed.select(*keys).exceptAll(stored.select(*keys)).count() == 0


def test_late_reading_is_dropped(spark, tmp_path):
    def arrive(name, rows):
        text = "\n".join(["ts,k,v", *rows])
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / name).write_text(text + "\n")
        stream = bw.stream_csv(spark, str(tmp_path / "in"), "ts TIMESTAMP, k INT, v DOUBLE")
        bw.write_window_stats(
            stream, "k", "ts", "v", watermark="1 hour", path=str(tmp_path / "out"),
            checkpoint=str(tmp_path / "checkpoint"),
        ).awaitTermination()
        return sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).select("k", "min_v").collect())

    assert arrive("a.csv", ["2024-01-01T10:00:00,1,1.0", "2024-01-03T10:00:00,1,3.0"]) == [(1, 1.0)]
    late = ["2024-01-01T11:00:00,1,-5.0", "2024-01-05T10:00:00,1,5.0"]
    assert arrive("b.csv", late) == [(1, 1.0), (1, 3.0)]


def test_rejected_and_static_anomalies_on_a_stream(spark, tmp_path):
    source = five_turbines(tmp_path / "in", broken=OUTLIER)
    good = bw.read_csv(spark, source, SPEC.schema).where("power_output < 1000")
    baseline = bw.fit_baseline(good, SPEC.key, SPEC.value)
    stream = bw.stream_csv(spark, source, SPEC.schema)
    for budget in (1 << 26, 1):
        found = bw.detect_anomalies(stream, SPEC.key, SPEC.value, k=4, baseline=baseline, broadcast_bytes=budget)
        root = tmp_path / f"found-{budget}"
        (
            found.writeStream.format("parquet").option("path", str(root / "t"))
            .option("checkpointLocation", str(root / "c")).trigger(availableNow=True).start().awaitTermination()
        )
        assert [r.power_output for r in spark.read.parquet(str(root / "t")).collect()] == [9999.0]
    rejected = bw.rejected_rows(stream)
    (
        rejected.writeStream.format("parquet").option("path", str(tmp_path / "r"))
        .option("checkpointLocation", str(tmp_path / "rc")).trigger(availableNow=True).start().awaitTermination()
    )
    assert spark.read.parquet(str(tmp_path / "r")).count() == 1


def test_expectations_of_bronze_need_its_columns(spark, tmp_path):
    stream = bw.stream_csv(spark, five_turbines(tmp_path / "in"), SPEC.schema)
    with pytest.raises(Exception, match="nope"):
        ingest(stream, bw.Lake(str(tmp_path / "lake")), rules={"bad": "nope > 1"})


def test_completeness_on_a_stream_is_approximate_by_name_only(spark, tmp_path):
    stream = bw.stream_csv(spark, five_turbines(tmp_path / "in", files=2), SPEC.schema)
    with pytest.raises(ValueError, match="stream"):
        bw.group_completeness(stream, "filename", "turbine_id", 5)
    result = bw.group_completeness(stream, "filename", "turbine_id", 5, approximate=True)
    assert result.columns == ["filename", "approx_distinct_keys"]
    query = result.writeStream.format("memory").queryName("complete").outputMode("complete")
    query.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    assert [r.approx_distinct_keys for r in spark.table("complete").collect()] == [5, 5]


@pytest.mark.parametrize("scope", ["history", "batch"])
def test_completeness_is_stored(spark, tmp_path, scope):
    lake = bw.Lake(str(tmp_path / "lake"))
    source = five_turbines(tmp_path / "in", files=2)
    (tmp_path / "in" / "short.csv").write_text(
        "timestamp,turbine_id,wind_speed,wind_direction,power_output\n2022-03-01T00:00:00,1,11.0,169,100.0\n"
    )
    bw.run_incremental(spark, source, lake, SPEC, scope=scope, maxFilesPerTrigger=1)
    stored = lake.read(spark, "completeness").select("unique_turbine_count", "is_valid").collect()
    assert sorted(map(tuple, stored)) == [(1, False), (5, True), (5, True)]


@pytest.mark.parametrize("scope", ["history", "batch"])
def test_no_file_is_too_old_and_every_violation_counts(spark, tmp_path, scope):
    lake, source = bw.Lake(str(tmp_path / "lake")), five_turbines(tmp_path / "in")
    assert bw.run_incremental(spark, source, lake, SPEC, scope=scope)  == {}
    five_turbines(tmp_path / "in", files=6)
    day = 24 * 3600
    for age, number in enumerate(range(1, 6)):
        path = tmp_path / "in" / f"group_{number}.csv"
        then = path.stat().st_mtime - 100 * day * age
        os.utime(path, (then, then))
    name = "spark.sql.streaming.numRecentProgressUpdates"
    spark.conf.set(name, 2)
    rules = {"never": "power_output < 0"}
    try:
        seen = bw.run_incremental(spark, source, lake, SPEC, scope=scope, rules=rules, maxFilesPerTrigger=1)
        assert spark.conf.get(name) == "2"
    finally:
        spark.conf.unset(name)
    assert seen == {"rows": 100, "never": 100}
    assert lake.read(spark, "bronze").count() == 120


@pytest.mark.parametrize("scope", ["history", "batch"])
def test_empty_tables_can_be_read(spark, tmp_path, scope):
    lake = bw.Lake(str(tmp_path / "lake"))
    bw.run_incremental(spark, five_turbines(tmp_path / "in"), lake, SPEC, scope=scope)
    for name in ("anomalies", "rejected"):
        table = lake.read(spark, name)
        assert table.count() == 0 and {"power_output", "insert_timestamp"} <= set(table.columns)


def test_named_tables_of_batches(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS batches")
    lake = bw.Lake(str(tmp_path / "it's a lake"), database="batches")
    source = five_turbines(tmp_path / "in", broken=OUTLIER)
    bw.run_incremental(spark, source, lake, SPEC, scope="batch")
    five_turbines(tmp_path / "in", files=2, broken=OUTLIER)
    bw.run_incremental(spark, source, lake, SPEC, scope="batch")
    for name in (*TABLES, "completeness"):
        table = bw.read_table(spark, f"batches.{name}")
        assert table.count() == lake.read(spark, name).count() > 0
        assert {"year", "month", "day", "batch_id"} <= set(table.columns)
    spark.sql("DROP DATABASE batches CASCADE")


def test_a_stream_needs_a_baseline_and_has_no_emptiness(spark, tmp_path):
    source = five_turbines(tmp_path / "in")
    stream = bw.stream_csv(spark, source, SPEC.schema)
    for judge in (bw.clean, bw.detect_anomalies):
        with pytest.raises(ValueError, match="stream"):
            judge(stream, SPEC.key, SPEC.value)
    baseline = bw.fit_baseline(bw.read_csv(spark, source, SPEC.schema), SPEC.key, SPEC.value)
    with pytest.raises(ValueError, match="stream"):
        bw.clean(stream, SPEC.key, SPEC.value, baseline=baseline, require_non_empty=True)
    assert bw.clean(stream, SPEC.key, SPEC.value, baseline=baseline).isStreaming
