import math

import pytest
from conftest import readings, turbine_rows
from pyspark.sql import functions as F

import bandwright as bw


def ids(df):
    return sorted(row["id"] for row in df.select("id").collect())


def test_sample_keeps_nine_readings(sample):
    kept = bw.clean(sample, "turbine_id", "power_output")
    assert kept.columns == sample.columns
    assert kept.count() == 9
    assert kept.where("power_output IS NULL OR power_output > 150").count() == 0


def test_limits_are_inclusive(spark):
    # Mean 0 and sample deviation 1, so that both ±k are hit exactly.
    df = readings(spark, [("a", -1.0), ("a", 0.0), ("a", 1.0)])
    assert ids(bw.clean(df, "sensor", "value", k=1)) == [0, 1, 2]
    assert ids(bw.detect_anomalies(df, "sensor", "value", k=1)) == []
    assert ids(bw.clean(df, "sensor", "value", k=0.99)) == [1]
    assert ids(bw.detect_anomalies(df, "sensor", "value", k=0.99)) == [0, 2]


def test_band_comes_from_complete_rows_including_outliers(spark):
    rows = [("2022-03-01 00:00:00", 1, None, 1, 1000.0)] + [
        ("2022-03-01 00:00:00", 1, 1.0, 1, power) for power in (10.0, 11.0, 12.0, 13.0)
    ]
    kept = bw.clean(turbine_rows(spark, rows), "turbine_id", "power_output")
    assert sorted(r.power_output for r in kept.collect()) == [10.0, 11.0, 12.0, 13.0]


def test_subset_limits_which_gaps_count(spark):
    rows = [("2022-03-01 00:00:00", 1, None, 1, power) for power in (10.0, 11.0, 12.0)]
    df = turbine_rows(spark, rows)
    assert bw.clean(df, "turbine_id", "power_output").count() == 0
    assert bw.clean(df, "turbine_id", "power_output", subset=["turbine_id", "power_output"]).count() == 3


def test_nan_row_is_dropped_and_spoils_nothing(spark):
    df = readings(spark, [("a", v) for v in (1.0, 2.0, 3.0, math.nan)])
    assert ids(bw.clean(df, "sensor", "value")) == [0, 1, 2]


def test_null_entity_is_dropped(spark):
    df = readings(spark, [(None, 1.0), (None, 2.0), ("a", 1.0), ("a", 2.0)])
    assert ids(bw.clean(df, "sensor", "value")) == [2, 3]
    assert ids(bw.clean(df, "sensor", "value", subset=["value"])) == [2, 3]


def test_single_reading_has_no_band(spark):
    df = readings(spark, [("a", 1.0), ("b", 1.0), ("b", 2.0)])
    assert ids(bw.clean(df, "sensor", "value")) == [1, 2]
    assert ids(bw.clean(df, "sensor", "value", on_undefined="keep")) == [0, 1, 2]
    assert ids(bw.detect_anomalies(df, "sensor", "value")) == []


def test_constant_readings_are_in_band(spark):
    df = readings(spark, [("a", 0.1)] * 3)
    assert ids(bw.clean(df, "sensor", "value")) == [0, 1, 2]
    assert ids(bw.detect_anomalies(df, "sensor", "value")) == []
    # Mean of 3 × 0.1 is off by one bit.
    assert ids(bw.clean(df, "sensor", "value", zero_band="reference")) == []
    assert ids(bw.detect_anomalies(df, "sensor", "value", zero_band="reference")) == [0, 1, 2]


def test_integer_and_decimal_values(spark):
    df = readings(spark, [("a", float(v)) for v in (1, 2, 3, 2, 1, 2, 3, 2, 99)])
    expected = ids(bw.clean(df, "sensor", "value"))
    assert expected == list(range(8))
    for kind in ("int", "decimal(10,2)", "float"):
        assert ids(bw.clean(df.withColumn("value", F.col("value").cast(kind)), "sensor", "value")) == expected


def test_bad_arguments(sample):
    for k in (0, -1, "2", True, None, math.nan):
        with pytest.raises(ValueError):
            bw.clean(sample, "turbine_id", "power_output", k=k)
    with pytest.raises(bw.MissingColumnsError, match="nope"):
        bw.clean(sample, "nope", "power_output")
    with pytest.raises(ValueError):
        bw.clean(None, "turbine_id", "power_output")
    with pytest.raises(TypeError):
        bw.clean([1], "turbine_id", "power_output")
    with pytest.raises(ValueError):
        bw.clean(sample, "turbine_id", "power_output", on_undefined="maybe")
    with pytest.raises(ValueError):
        bw.clean(sample, "turbine_id", "power_output", zero_band="maybe")


def test_guards_name_the_reason(spark):
    def run(rows, **options):
        return bw.clean(readings(spark, rows), "sensor", "value", require_non_empty=True, **options)

    with pytest.raises(bw.EmptyFrameError, match="no rows"):
        run([])
    with pytest.raises(bw.EmptyFrameError, match="incomplete"):
        run([("a", None)])
    with pytest.raises(bw.EmptyFrameError, match="outside"):
        run([("a", 1.0)])
    assert run([("a", 1.0), ("a", 2.0)]).count() == 2
