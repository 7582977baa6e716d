import math

import pytest
from conftest import readings, turbine_rows
from pyspark.sql import functions as F

import bandwright as bw
from bandwright import presets


def test_sample_has_one_anomaly(sample):
    (found,) = bw.detect_anomalies(sample, "turbine_id", "power_output", label="power").collect()
    assert found["power_output"] == 200.0
    assert found["mean_power"] == pytest.approx(112.68)
    assert found["stddev_power"] == pytest.approx(32.2371, abs=1e-4)


def test_output_columns(sample):
    spec = presets.wind_power_spec()
    stamped = bw.with_load_columns(sample)
    found = bw.detect_anomalies(stamped, "turbine_id", "power_output", keep=spec.anomaly_columns, label="power")
    assert found.columns == list(spec.anomaly_columns)
    contract = presets.wind_power_contracts(
        {name: {"path": "/nowhere"} for name in ("cleaned", "stats", "anomalies", "rejected")},
        dict.fromkeys(("cleaned", "stats", "anomalies", "rejected"), "csv"),
    )["anomalies"]
    assert contract.differences(found) == []
    default = bw.detect_anomalies(sample, "turbine_id", "power_output")
    assert default.columns == [*sample.columns, "mean_power_output", "stddev_power_output"]


def test_band_comes_from_raw_rows(spark):
    """With gaps in other columns a row can be rejected and anomalous, and a kept row anomalous too."""
    rows = [("2022-03-01 00:00:00", 1, 1.0, 1, power) for power in (8.0, 12.0) * 3]
    rows += [("2022-03-01 00:00:00", 1, None, 1, 10.0)] * 40
    df = turbine_rows(spark, rows)
    found = bw.detect_anomalies(df, "turbine_id", "power_output")
    kept = bw.clean(df, "turbine_id", "power_output")
    assert found.count() == 6
    assert kept.count() == 6


def test_one_nan_does_not_flag_the_rest(spark):
    df = readings(spark, [("a", float(v)) for v in range(10)] + [("a", math.nan)])
    assert bw.detect_anomalies(df, "sensor", "value").count() == 0
    as_is = bw.detect_anomalies(df, "sensor", "value", nan_is_null=False, zero_band="reference")
    assert as_is.count() == 10


def test_baseline_from_elsewhere(spark):
    history = readings(spark, [("a", float(v)) for v in (9, 10, 11)] + [("c", 5.0)] * 3 + [("s", 1.0)])
    baseline = bw.fit_baseline(history, "sensor", "value")
    new = readings(spark, [("a", 12.5), ("a", 11.9), ("b", 1e9), ("c", 5.0), ("c", 6.0), ("s", 1e9)])
    found = bw.detect_anomalies(new, "sensor", "value", baseline=baseline)
    # Unknown entities and entities with one reading have no band; a constant one has exactly its value.
    assert sorted(r["id"] for r in found.collect()) == [0, 4]
    kept = bw.clean(new, "sensor", "value", baseline=baseline)
    assert sorted(r["id"] for r in kept.collect()) == [1, 3]


@pytest.mark.parametrize("budget", [1 << 26, 200])
def test_stored_baseline(spark, tmp_path, budget):
    history = readings(spark, [(name, float(v)) for name in "abc" for v in (9, 10, 11)])
    path = str(tmp_path / "baseline")
    bw.store_baseline(bw.fit_baseline(history, "sensor", "value"), path)
    stored = bw.load_baseline(spark, path, "sensor")
    assert (stored.entities, stored.readings, stored.key_bytes) == (3, 9, 1)
    new = readings(spark, [("a", 12.5), ("b", 11.9), ("c", 7.0)])
    found = bw.detect_anomalies(new, "sensor", "value", baseline=stored, broadcast_bytes=budget)
    assert sorted((r.id, r.mean_value, r.stddev_value) for r in found.collect()) == [(0, 10.0, 1.0), (2, 10.0, 1.0)]
    with pytest.raises(bw.MissingColumnsError):
        bw.load_baseline(spark, path, "turbine")


def test_larger_k_finds_fewer(spark):
    df = readings(spark, [("a", math.sin(i * i) * i) for i in range(200)])
    counts = [bw.detect_anomalies(df, "sensor", "value", k=k).count() for k in (0.5, 1, 1.5, 2, 3)]
    assert counts == sorted(counts, reverse=True) and counts[0] > counts[-1]


def test_missing_output_column(sample):
    with pytest.raises(bw.MissingColumnsError, match="nope"):
        bw.detect_anomalies(sample, "turbine_id", "power_output", keep=["nope"])


def test_rejected_rows(spark, sample):
    assert bw.rejected_rows(sample).count() == 1
    df = readings(spark, [("a", 1.0), (None, 1.0), ("a", None), ("a", math.nan)])
    assert sorted(r.id for r in bw.rejected_rows(df).collect()) == [1, 2, 3]
    assert sorted(r.id for r in bw.rejected_rows(df, nan_is_null=False).collect()) == [1, 2]
    assert sorted(r.id for r in bw.rejected_rows(df, ["sensor"]).collect()) == [1]
    assert sorted(r.id for r in df.where(bw.is_complete(df)).collect()) == [0]
    assert sorted(r.id for r in df.dropna().collect()) == [0]


def test_quality_report(sample):
    report = bw.quality_report(bw.with_load_columns(sample), presets.wind_power_spec())
    assert report.anomalies.count() == 1
    assert report.rejected.count() == 1
    assert [r.asDict() for r in report.completeness.collect()] == [
        {"filename": "test.csv", "unique_turbine_count": 1, "is_valid": False}
    ]
    with pytest.raises(bw.MissingColumnsError, match="wind_speed"):
        bw.quality_report(sample.drop("wind_speed"), presets.wind_power_spec())
    with pytest.raises(TypeError):
        bw.quality_report("sample", presets.wind_power_spec())


def test_column_names_do_not_clash(spark):
    df = readings(spark, [("a", float(v)) for v in (1, 2, 3, 2, 1, 2, 3, 2, 99)]).withColumns(
        {"mean": F.lit(1), "rows": F.lit(2), "low": F.lit(3)}
    )
    assert bw.detect_anomalies(df, "sensor", "value").count() == 1
    assert bw.clean(df.withColumnRenamed("sensor", "readings"), "readings", "value").count() == 8


def test_one_infinite_reading_condemns_no_other(spark):
    rows = [("a", 10.0 + i % 3) for i in range(8)] + [("a", float("inf")), ("b", float("-inf")), ("b", 1.0)]
    df = readings(spark, rows)
    found = bw.detect_anomalies(df, "sensor", "value").collect()
    assert sorted(row.value for row in found) == [float("-inf"), float("inf")]
    assert bw.clean(df, "sensor", "value").count() == 8
    assert bw.clean(df, "sensor", "value", on_undefined="keep").count() == 9


def test_merged_baselines_equal_one_of_all(spark, tmp_path):
    rows = [("a", float(i * i % 17)) for i in range(20)] + [("b", 5.0), ("c", None), ("b", 5.0), ("d", 1.0), ("d", 4.0)]
    df = readings(spark, rows)
    halves = [bw.fit_baseline(df, "sensor", "value", F.col("id") % 3 == 0), bw.fit_baseline(df, "sensor", "value", F.col("id") % 3 != 0)]
    whole, merged = bw.fit_baseline(df, "sensor", "value"), bw.merge_baselines(*halves)
    bw.store_baseline(merged, str(tmp_path / "stored"))
    again = bw.load_baseline(spark, str(tmp_path / "stored"), "sensor")
    assert (whole.entities, whole.readings, whole.used) == (merged.entities, merged.readings, merged.used)
    assert (again.readings, again.used) == (whole.readings, whole.used) == (25, 24)

    def rounded(baseline):
        rows = baseline.frame.collect()
        return sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in row) for row in rows)

    assert rounded(whole) == rounded(merged) == rounded(again)
