import math

import pytest
from conftest import five_turbines

import bandwright as bw
from bandwright import presets

RAW = presets.RAW_COLUMNS


def test_csv_with_declared_schema_and_lineage(spark, tmp_path):
    df = bw.read_csv(spark, five_turbines(tmp_path / "in", files=2), RAW)
    assert df.dtypes == [
        ("timestamp", "timestamp"),
        ("turbine_id", "int"),
        ("wind_speed", "double"),
        ("wind_direction", "bigint"),
        ("power_output", "double"),
        ("filename", "string"),
    ]
    assert df.count() == 40
    names = {row.filename.rsplit("/", 1)[1] for row in df.select("filename").distinct().collect()}
    assert names == {"group_0.csv", "group_1.csv"}
    one = bw.read_csv(spark, str(tmp_path / "in" / "group_1.csv"), RAW, file_column=None)
    assert one.count() == 20 and "filename" not in one.columns


def test_bad_fields_become_null(spark, tmp_path):
    broken = [
        "2022-03-01T05:00:00,1,11.0,169,abc",
        "2022-03-01T05:00:00,2,11.0,169.5,1.0",
        "bad,3,11.0,169,1.0",
        "2022-03-01T05:00:00,4,11.0,169",
        "2022-03-01T05:00:00,,11.0,169,1.0",
        "2022-03-01T05:00:00,5,11.0,169,NaN",
    ]
    df = bw.read_csv(spark, five_turbines(tmp_path / "in", broken=broken), RAW)
    rows = {r.turbine_id: r for r in bw.rejected_rows(df).collect()}
    assert len(rows) == 6
    assert rows[1].power_output is None and rows[1].wind_direction == 169
    assert rows[2].wind_direction is None and rows[2].power_output == 1.0
    assert rows[3].timestamp is None
    assert rows[4].power_output is None
    assert rows[None].power_output == 1.0
    assert math.isnan(rows[5].power_output)
    assert bw.rejected_rows(df, nan_is_null=False).count() == 5


def test_corrupt_text_can_be_kept(spark, tmp_path):
    bad = "2022-03-01T05:00:00,1,11.0,169,abc"
    path = five_turbines(tmp_path / "in", broken=[bad])
    df = bw.read_csv(spark, path, RAW, corrupt_column="text").cache()
    assert [r.text for r in df.where("text IS NOT NULL").collect()] == [bad]
    df.unpersist()
    spec = presets.wind_power_spec(corrupt_column="text")
    with bw.run_batch(spark, path, spec) as outputs:
        assert outputs.rows == 21 and outputs.rejected_rows == 1
        assert [r.text for r in outputs.rejected.collect()] == [bad]
        assert outputs.cleaned.count() == 20


def test_bad_paths(spark, tmp_path):
    for path in ("", None):
        with pytest.raises(ValueError, match="path"):
            bw.read_csv(spark, path, RAW)
    with pytest.raises(ValueError, match="schema"):
        bw.read_csv(spark, "x", None)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        bw.read_csv(spark, str(tmp_path / "absent"), RAW)


def test_stream_has_the_same_columns(spark, tmp_path):
    path = five_turbines(tmp_path / "in")
    stream = bw.stream_csv(spark, path, RAW)
    assert stream.isStreaming
    assert stream.dtypes == bw.read_csv(spark, path, RAW).dtypes
