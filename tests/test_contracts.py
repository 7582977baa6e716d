import pytest
from conftest import turbine_rows
from pyspark.sql import functions as F

import bandwright as bw
from bandwright import presets

ROWS = [("2025-07-14T06:30:00", 1, 8.4, 210, 91.25), ("2025-07-14T06:40:00", 2, 7.9, 215, 88.5)]


def cleaned_contract(fmt="parquet", path="/nowhere", **options):
    return bw.DatasetContract("cleaned", presets.CLEANED_COLUMNS, fmt, {"path": path, **options})


@pytest.fixture
def stamped(spark):
    return bw.with_load_columns(turbine_rows(spark, ROWS), "2025-02-03 13:00:00.123456")


def test_shuffled_columns_conform(stamped):
    contract = cleaned_contract()
    shuffled = stamped.select(*sorted(stamped.columns)).withColumn("more", F.lit(1))
    assert contract.differences(shuffled)
    assert contract.differences(contract.conform(shuffled)) == []


def test_differences_name_the_columns(stamped):
    contract = cleaned_contract()
    good = contract.conform(stamped)
    assert contract.differences(good.drop("day")) == ["expected 10 columns, got 9", "missing column day"]
    assert contract.differences(good.withColumn("more", F.lit(1))) == [
        "expected 10 columns, got 11",
        "unexpected column more",
    ]
    assert contract.differences(good.withColumn("turbine_id", F.col("turbine_id").cast("bigint"))) == [
        "column 2: expected turbine_id int, got turbine_id bigint"
    ]
    first, second, *rest = good.columns
    assert len(contract.differences(good.select(second, first, *rest))) == 2
    with pytest.raises(bw.ContractError, match="turbine_id"):
        contract.verify(good.withColumn("turbine_id", F.lit("x")))
    with pytest.raises(bw.MissingColumnsError, match="filename"):
        contract.conform(stamped.drop("filename"))
    with pytest.raises(ValueError):
        contract.differences(None)


def test_options_are_checked_early():
    jdbc = {"driver": "d", "url": "u", "dbtable": "t", "username": "me", "password": "secret"}
    contract = bw.DatasetContract("stats", presets.STATS_COLUMNS, "jdbc", jdbc)
    assert contract.options["user"] == "me" and "username" not in contract.options
    assert "secret" not in repr(contract)
    for name in jdbc:
        with pytest.raises(bw.ContractError, match="missing jdbc options"):
            bw.DatasetContract("stats", presets.STATS_COLUMNS, "jdbc", {k: v for k, v in jdbc.items() if k != name})
        with pytest.raises(bw.ContractError, match="missing jdbc options"):
            bw.DatasetContract("stats", presets.STATS_COLUMNS, "jdbc", {**jdbc, name: ""})
    with pytest.raises(bw.ContractError, match="path"):
        bw.DatasetContract("cleaned", presets.CLEANED_COLUMNS, "csv", {})
    with pytest.raises(bw.ContractError, match="unsupported format"):
        bw.DatasetContract("cleaned", presets.CLEANED_COLUMNS, "xlsx", {"path": "p"})
    with pytest.raises(bw.ContractError, match="partition columns"):
        bw.DatasetContract("raw", presets.RAW_COLUMNS, "csv", {"path": "p"})


def test_presets_have_the_fixed_columns():
    jdbc = {"driver": "d", "url": "u", "dbtable": "t", "user": "me", "password": "p"}
    made = presets.wind_power_contracts(
        {"cleaned": jdbc, "stats": jdbc, "anomalies": {"path": "a"}, "rejected": {"path": "r"}}
    )
    assert {name: c.format for name, c in made.items()} == presets.DEFAULT_FORMATS
    assert made["rejected"].schema.names == [
        "timestamp", "turbine_id", "wind_speed", "wind_direction", "power_output",
        "year", "month", "day", "insert_timestamp", "filename",
    ]
    assert made["stats"].schema.names == [
        "turbine_id", "start", "end", "min_power", "max_power", "avg_power", "stddev_power",
        "year", "month", "day", "insert_timestamp",
    ]
    assert presets.raw_contract("p").schema.names == [
        "timestamp", "turbine_id", "wind_speed", "wind_direction", "power_output",
    ]


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_round_trip_is_exact(spark, stamped, tmp_path, fmt):
    contract = cleaned_contract(fmt, str(tmp_path / "t"))
    precise = contract.conform(stamped.withColumn("timestamp", F.expr("timestamp'2024-01-01 00:03:52.824425'")))
    bw.write_contract(precise, contract)
    assert (tmp_path / "t" / "year=2025" / "month=2" / "day=3").is_dir()
    back = bw.read_contract(spark, contract)
    assert contract.differences(back) == []
    assert sorted(back.collect()) == sorted(precise.collect())


def test_csv_has_no_header_and_survives_text(spark, tmp_path):
    columns = "name STRING, ts TIMESTAMP_NTZ, v DOUBLE"
    contract = bw.DatasetContract("t", columns, "csv", {"path": str(tmp_path / "t")}, partition_by=())
    rows = [('a "quoted" \\" text', 1.5), (None, float("inf")), ("comma, here", None), ("\\", 5e-324)]
    df = spark.createDataFrame(rows, "name STRING, v DOUBLE").select(
        "name", F.expr("timestamp_ntz'2024-01-01 00:00:00.000001'").alias("ts"), "v"
    )
    bw.write_contract(df, contract)
    lines = [line for part in (tmp_path / "t").glob("part-*") for line in part.read_text().splitlines()]
    assert len(lines) == len(rows) and not any(line.startswith("name") for line in lines)
    key = lambda row: tuple(str(cell) for cell in row)
    assert sorted(bw.read_contract(spark, contract).collect(), key=key) == sorted(df.collect(), key=key)


def test_save_modes(spark, stamped, tmp_path):
    contract = cleaned_contract("parquet", str(tmp_path / "t"))
    df = contract.conform(stamped)
    later = contract.conform(bw.with_load_columns(stamped, "2025-02-04"))
    count = lambda: bw.read_contract(spark, contract).count()
    bw.write_contract(df, contract, "error")
    with pytest.raises(Exception, match="already exists"):
        bw.write_contract(df, contract, "error")
    bw.write_contract(df, contract, "ignore")
    assert count() == 2
    bw.write_contract(df, contract, "append")
    assert count() == 4
    bw.write_contract(later, contract, "overwrite", dynamic_overwrite=True)
    assert count() == 6
    bw.write_contract(later, contract, "overwrite", dynamic_overwrite=True)
    assert count() == 6
    bw.write_contract(later, contract, "overwrite", rebalance=True)
    assert count() == 2
    with pytest.raises(ValueError, match="mode"):
        bw.write_contract(df, contract, "replace")


def test_writer_refuses_bad_frames(stamped, tmp_path):
    contract = cleaned_contract("parquet", str(tmp_path / "t"))
    with pytest.raises(bw.ContractError):
        bw.write_contract(stamped, contract)
    with pytest.raises(ValueError):
        bw.write_contract(None, contract)
    with pytest.raises(ValueError):
        bw.write_contract(stamped, None)
    empty = contract.conform(stamped).where("false")
    with pytest.raises(bw.EmptyFrameError):
        bw.write_contract(empty, contract, require_non_empty=True)
    assert not (tmp_path / "t").exists()


def test_delta_without_connector(stamped, tmp_path):
    contract = cleaned_contract("delta", str(tmp_path / "t"))
    with pytest.raises(bw.UnavailableFormatError, match="delta"):
        bw.write_contract(contract.conform(stamped), contract)


def test_jdbc_options_reach_the_writer(stamped, monkeypatch):
    """No database is started here; this checks what Spark's JDBC writer would be asked to do."""
    from pyspark.sql.classic.dataframe import DataFrame  # noqa: F401
    from pyspark.sql.readwriter import DataFrameWriter

    asked = {}

    def note(name):
        def method(self, *args, **kwargs):
            asked.setdefault(name, []).append(kwargs or args)
            return self

        return method

    for name in ("format", "options", "mode", "partitionBy", "save"):
        monkeypatch.setattr(DataFrameWriter, name, note(name))
    options = {"driver": "d", "url": "jdbc:x", "dbtable": "t", "username": "me", "password": "p", "numPartitions": "8"}
    contract = bw.DatasetContract("cleaned", presets.CLEANED_COLUMNS, "jdbc", options)
    options_of = lambda contract: {name: contract.options[name] for name in bw.contracts.JDBC_OPTIONS}
    bw.write_contract(contract.conform(stamped), contract, "append")
    assert asked == {
        "format": [("jdbc",)],
        "options": [{**options_of(contract), "numPartitions": "8"}],
        "mode": [("append",)],
        "save": [()],
    }
    with pytest.raises(bw.ContractError, match="no partitions"):
        bw.write_contract(contract.conform(stamped), contract, "overwrite", dynamic_overwrite=True)


def test_plain_writers(spark, stamped, tmp_path):
    bw.write_parquet(stamped, str(tmp_path / "p"))
    assert (tmp_path / "p" / "year=2025").is_dir()
    bw.write_parquet(stamped, str(tmp_path / "p"), "append", partition_by=["turbine_id"])
    assert spark.read.parquet(str(tmp_path / "p" / "turbine_id=1")).count() == 1
    bw.write_csv(stamped, str(tmp_path / "c"), header=True)
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).count() == 2
    for write in (bw.write_csv, bw.write_parquet, bw.write_delta):
        with pytest.raises(ValueError, match="path"):
            write(stamped, "")
        with pytest.raises(ValueError, match="mode"):
            write(stamped, str(tmp_path / "x"), "replace")
    good = {"driver": "d", "url": "u", "dbtable": "t", "user": "me", "password": "p"}
    for name in good:
        with pytest.raises(ValueError, match=f"missing JDBC options: {name}"):
            bw.write_jdbc(stamped, **{**good, name: None})


def test_jdbc_error_is_passed_on(stamped):
    options = {"driver": "no.such.Driver", "url": "jdbc:x", "dbtable": "t", "user": "me", "password": "p"}
    contract = bw.DatasetContract("cleaned", presets.CLEANED_COLUMNS, "jdbc", options)
    with pytest.raises(Exception, match="no.such.Driver"):
        bw.write_contract(contract.conform(stamped), contract, "append")


def test_managed_table(spark, stamped, tmp_path):
    table = bw.ManagedTable("cleaned_readings", "It's cleaned", path=str(tmp_path / "t"))
    table.save(stamped)
    table.save(stamped, "append")
    assert bw.read_table(spark, "cleaned_readings").count() == 4
    about = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED cleaned_readings").collect()}
    assert about["Comment"] == "It's cleaned"
    assert [c.name for c in spark.catalog.listColumns("cleaned_readings") if c.isPartition] == ["year", "month", "day"]
    spark.sql("DROP TABLE cleaned_readings")
