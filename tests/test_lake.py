"""Versions, the ledger, merged statistics and streamed completeness."""

import importlib
import os
import time

import pytest
from conftest import five_turbines, readings
from pyspark.sql import DataFrameWriter, functions as F
from test_plans import nodes, plan

import bandwright as bw
from bandwright import presets
from bandwright.functions import LOAD_COLUMNS
from bandwright.operators import baseline as baselines
from bandwright.operators.baseline import WINDOW_READINGS, merge_profiles, profile
from bandwright.streaming import incremental, ingest, lake as lakes, rebuild, write_batch
from bandwright.streaming.lake import Version

SPEC = presets.wind_power_spec()
DERIVED = ("cleaned", "stats", "anomalies", "rejected", "completeness")
OUTLIER = [f"2022-03-01T1{i}:00:00,1,11.0,169,101.5" for i in range(8)] + [
    "2022-03-01T19:00:00,1,11.0,169,9999.0",
    "2022-03-01T20:00:00,2,11.0,169,",
]


def rows(df):
    numbers = [F.round(f.name, 6).alias(f.name) if f.dataType.typeName() == "double" else F.col(f.name)
               for f in df.schema.fields if f.name not in (*LOAD_COLUMNS, "batch_id")]
    return sorted(map(str, df.select(*numbers).collect()))


def contents(spark, lake):
    return {name: rows(lake.read(spark, name)) for name in DERIVED}


def test_second_run_fits_only_what_is_new(spark, tmp_path, monkeypatch):
    fitted, real = [], incremental.profiled
    monkeypatch.setattr(incremental, "profiled", lambda df, spec: fitted.append(df) or real(df, spec))
    lake, source = bw.Lake(str(tmp_path / "lake")), five_turbines(tmp_path / "in", files=2, broken=OUTLIER)
    bw.run_incremental(spark, source, lake, SPEC)
    five_turbines(tmp_path / "in", files=5, broken=OUTLIER)
    bw.run_incremental(spark, source, lake, SPEC)
    assert [df.count() for df in fitted] == [60, 90]
    text = plan(fitted[1])
    assert "PartitionFilters" in text and "batch_id" in text.split("PartitionFilters")[1].split("PushedFilters")[0]
    merged = contents(spark, lake)
    # The same from all of bronze at once.
    whole = bw.Lake(str(tmp_path / "whole"))
    ingest(bw.stream_csv(spark, source, SPEC.schema), whole)
    rebuild(spark, whole, SPEC)
    assert merged == contents(spark, whole) and len(merged["cleaned"]) == 140
    # Nothing new: nothing is fitted. Another band's width needs no other statistics, another entity does.
    bw.run_incremental(spark, source, lake, SPEC)
    assert len(fitted) == 3
    other = bw.ReadingSpec(**{**vars(SPEC), "key": "wind_direction"})
    rebuild(spark, lake, other)
    assert len(fitted) == 4 and fitted[3].count() == 150


def test_merged_profiles_equal_one_of_all(spark):
    df = readings(spark, [(f"s{i % 5}", float(i * i % 37)) for i in range(200)] + [("new", 1.0), (None, 3.0), ("s1", None)])
    parts = {"complete": F.col("id") % 3 > 0, "raw": None}
    counters = {"odd": F.col("id") % 2 == 1}
    first, second, whole = (
        profile(df.where(where), "sensor", "value", parts, counters=counters) for where in ("id < 70", "id >= 70", "true")
    )
    merged = merge_profiles(first, second)
    assert merged.sizes == whole.sizes
    assert rows(merged.frame.select(*sorted(merged.frame.columns))) == rows(whole.frame.select(*sorted(whole.frame.columns)))
    with pytest.raises(ValueError, match="differ"):
        merge_profiles(first, profile(df, "sensor", "value", parts))


@pytest.mark.parametrize("survivor", ["stats", "rejected", None])
def test_readers_see_all_tables_of_a_run_or_none(spark, tmp_path, monkeypatch, survivor):
    """A failure at the first, a later, or after the last table leaves the former ones whole."""
    lake, source = bw.Lake(str(tmp_path / "lake")), five_turbines(tmp_path / "in", files=2, broken=OUTLIER)
    bw.run_incremental(spark, source, lake, SPEC)
    before, real = contents(spark, lake), DataFrameWriter.save

    def failing(self, path=None, *args, **kwargs):
        if survivor and path and f"/{survivor}/v-" in path:
            raise OSError("lost")
        return real(self, path, *args, **kwargs)

    five_turbines(tmp_path / "in", files=4)
    monkeypatch.setattr(DataFrameWriter, "save", failing)
    if survivor is None:
        monkeypatch.setattr(lakes, "write_note", lambda spark, path, note: (_ for _ in ()).throw(OSError("lost"))
                            if "_versions" in path else None)
    with pytest.raises(OSError, match="lost"):
        bw.run_incremental(spark, source, lake, SPEC)
    assert contents(spark, lake) == before
    monkeypatch.undo()
    bw.run_incremental(spark, source, lake, SPEC)
    now = contents(spark, lake)
    assert all(now[name] != before[name] for name in ("cleaned", "stats", "completeness"))
    assert lake.read(spark, "bronze").count() == 100


def test_readers_that_have_begun_keep_their_version(spark, tmp_path):
    lake, source = bw.Lake(str(tmp_path / "lake")), five_turbines(tmp_path / "in")
    bw.run_incremental(spark, source, lake, SPEC)
    begun = lake.read(spark, "cleaned")
    for files in (2, 3, 4):
        if files == 3:
            assert begun.count() == 20
        five_turbines(tmp_path / "in", files=files)
        bw.run_incremental(spark, source, lake, SPEC)
    # Two versions of each table stay.
    assert len(list((tmp_path / "lake" / "cleaned").iterdir())) == 2
    assert len(list((tmp_path / "lake" / "_profile").iterdir())) == 2
    assert len(list((tmp_path / "lake" / "_versions").glob("*.json"))) == 2
    assert lake.read(spark, "cleaned").count() == 80
    assert bw.Lake(str(tmp_path / "none")).version(spark) == Version()


@pytest.mark.parametrize("scope", ["history", "batch"])
def test_ledger_counts_each_batch_once(spark, tmp_path, scope):
    lake, source = bw.Lake(str(tmp_path / "lake")), five_turbines(tmp_path / "in", files=3, broken=OUTLIER)
    assert lake.ledger(spark).count() == 0
    rules = {"high": "power_output < 102"}
    seen = bw.run_incremental(spark, source, lake, SPEC, scope=scope, rules=rules, maxFilesPerTrigger=1)
    ledger = lake.ledger(spark)
    total = {r.rule: r.n for r in ledger.groupBy("rule").agg(F.sum("violations").alias("n")).collect()}
    assert total == seen and seen["rows"] == 90
    assert ledger.select("query", "batch_id").distinct().count() == 3
    # A batch that is tried again replaces its counts and its rows, load date included.
    batch = bw.read_csv(spark, source, SPEC.schema)
    first = lake.read(spark, "bronze").where("batch_id = 1")
    stamps = [r[0] for r in first.select("insert_timestamp").distinct().collect()]
    if scope == "batch":
        write_batch(batch.where("turbine_id = 1"), 1, lake, SPEC, rules=rules)
    else:
        incremental._store(batch.where("turbine_id = 1"), 1, lake, "bronze", ("year", "month", "day", "batch_id"), rules)
    again = lake.read(spark, "bronze").where("batch_id = 1")
    assert again.count() == batch.where("turbine_id = 1").count()
    assert [r[0] for r in again.select("insert_timestamp").distinct().collect()] == stamps
    (row,) = lake.ledger(spark).where("batch_id = 1 AND rule = 'rows'").collect()
    assert row.violations == again.count()


def test_files_are_parsed_once_in_batch_scope(spark, tmp_path):
    """The micro-batch itself is only written to bronze; judging reads bronze's own partition."""
    lake, source = bw.Lake(str(tmp_path / "lake")), five_turbines(tmp_path / "in", files=2, broken=OUTLIER)
    parsed = spark.sparkContext.accumulator(0)
    batch = bw.read_csv(spark, source, SPEC.schema)
    n = batch.count()
    counted = batch.mapInArrow(lambda it: (parsed.add(b.num_rows) or b for b in it), batch.schema)
    write_batch(counted, 3, lake, SPEC)
    assert parsed.value == n == lake.read(spark, "bronze").count()


def test_window_plan_is_one_scan_and_one_shuffle(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet").select("user_id", "ts", "value")
    for judged in (bw.clean(events, "user_id", "value", plan="window"), bw.detect_anomalies(events, "user_id", "value", plan="window")):
        assert nodes(judged, "FileScan parquet") == 1 and nodes(judged, "Exchange hashpartitioning") == 1
        assert "Join" not in plan(judged)
    with pytest.raises(ValueError, match="plan"):
        bw.clean(events, "user_id", "value", plan="sort")


def test_window_plan_agrees_and_gives_way_to_hot_entities(spark, monkeypatch):
    nan, inf = float("nan"), float("inf")
    values = [10.0, 11.0, 12.0, 9.0, 10.5, 11.5, 10.2, 300.0, None, nan, inf]
    df = readings(spark, [(f"s{i % 3}" if i % 17 else None, v) for i, v in enumerate(values * 9)] + [("one", 5.0), ("same", 1.0), ("same", 1.0)])
    assert WINDOW_READINGS > 100
    for most in (WINDOW_READINGS, 5):
        monkeypatch.setattr(importlib.import_module("bandwright.operators.clean"), "WINDOW_READINGS", most)
        for undefined in ("drop", "keep"):
            plans = [bw.clean(df, "sensor", "value", on_undefined=undefined, plan=p) for p in ("join", "window")]
            assert rows(plans[0]) == rows(plans[1])
            assert ("Window" in plan(plans[1])) == (most > 100)
    for options in ({}, {"nan_is_null": False}):
        plans = [bw.detect_anomalies(df, "sensor", "value", plan=p, **options) for p in ("join", "window")]
        assert rows(plans[0]) == rows(plans[1]) and rows(plans[0])
    assert baselines.largest_entity(df, "sensor") == df.where("sensor = 's1'").count()
    assert baselines.largest_entity(df.where("false"), "sensor") == 0


def test_streamed_completeness_is_exact_and_drops_what_is_late(spark, tmp_path):
    def arrive(name, lines):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / name).write_text("\n".join(["ts,plant,sensor", *lines]) + "\n")
        stream = bw.stream_csv(spark, str(tmp_path / "in"), "ts TIMESTAMP, plant STRING, sensor INT", file_column=None)
        bw.write_stream_completeness(
            stream, "plant", "sensor", "ts", 2, path=str(tmp_path / "out"), checkpoint=str(tmp_path / "c")
        ).awaitTermination()
        found = spark.read.parquet(str(tmp_path / "out")).collect()
        return sorted((r.start.day, r.plant, r.distinct_keys, r.is_valid) for r in found)

    first = ["2024-01-01T10:00:00,a,1", "2024-01-01T11:00:00,a,2", "2024-01-01T12:00:00,a,2", "2024-01-01T12:00:00,b,7",
             "2024-01-01T13:00:00,b,", "2024-01-02T10:00:00,a,1"]
    day_one = [(1, "a", 2, True), (1, "b", 1, False)]
    assert arrive("one.csv", first) == day_one
    second = ["2024-01-01T23:00:00,b,8", "2024-01-02T12:00:00,a,2", "2024-01-02T12:30:00,a,3", "2024-01-03T12:00:00,a,1"]
    assert arrive("two.csv", second) == [*day_one, (2, "a", 3, False)]


def test_batch_and_stream_completeness_agree(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet").withColumn("day", F.to_date("ts"))
    whole = bw.stream_completeness(events, "event_type", "user_id", "ts", 20)
    direct = bw.group_completeness(events.withColumn("g", F.concat_ws("/", "day", "event_type")), "g", "user_id", 20)
    counts = lambda df: sorted(map(tuple, df.select("distinct_keys", "is_valid").collect()))
    assert counts(whole) == counts(direct)


@pytest.mark.parametrize("scope", ["history", "batch"])
def test_read_files_are_archived_and_late_ones_come_in_once(spark, tmp_path, scope):
    lake, source, archive = bw.Lake(str(tmp_path / "lake")), tmp_path / "in", tmp_path / "archive"
    five_turbines(source)

    def run():
        bw.run_incremental(spark, str(source), lake, SPEC, scope=scope, archive_dir=str(archive), remember_days=7)
        return lake.read(spark, "bronze").groupBy("filename").count().collect()

    def left(n):
        # Files are moved in the background, after the next batch has begun.
        until = time.time() + 20
        while len(list(source.glob("*.csv"))) > n and time.time() < until:
            time.sleep(0.1)
        return sorted(path.name for path in source.glob("*.csv"))

    assert len(run()) == 1
    text = (source / "group_0.csv").read_text()
    for number in (1, 2):
        (source / f"group_{number}.csv").write_text(text)
        assert len(run()) == number + 1
    assert left(1) == ["group_2.csv"]
    assert sorted(path.name for path in archive.rglob("*.csv")) == ["group_0.csv", "group_1.csv"]
    # Older than what the stream remembers, by far; one with a name that needs quoting.
    for name in ("late.csv", "very late.csv"):
        (source / name).write_text(text)
        then = time.time() - 90 * 24 * 3600
        os.utime(source / name, (then, then))
    # And one that was read already but waits to be archived.
    os.utime(source / "group_2.csv", (then, then))
    counts = run()
    assert len(counts) == 5 and {row["count"] for row in counts} == {20}
    assert {row["count"] for row in run()} == {20}
    (source / "group_3.csv").write_text(text)
    counts = run()
    assert len(counts) == 6 and {row["count"] for row in counts} == {20}


def test_bronze_takes_new_columns(spark, tmp_path):
    lake = bw.Lake(str(tmp_path / "lake"))
    ingest(bw.stream_csv(spark, five_turbines(tmp_path / "in"), SPEC.schema), lake)
    number = lake.version(spark).number
    (tmp_path / "in" / "wide.csv").write_text(
        "timestamp,turbine_id,wind_speed,wind_direction,power_output,state\n2022-03-01T00:00:00,1,11.0,169,100.0,on\n"
    )
    wide = bw.stream_csv(spark, str(tmp_path / "in"), f"{SPEC.schema.simpleString()[7:-1].replace(':', ' ')}, state string")
    ingest(wide, lake)
    assert lake.version(spark).number == number + 1
    bronze = lake.read(spark, "bronze")
    assert [bronze.where(condition).count() for condition in ("state IS NULL", "state = 'on'")] == [20, 1]
