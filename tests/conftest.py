import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession, functions as F

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

# Eleven readings (time, power) of one turbine, one of them missing, one far off.
SAMPLE = [
    ("2022-03-01 00:00:00", 95.7),
    ("2022-03-01 00:00:00", 95.8),
    ("2022-03-01 00:00:00", 95.9),
    ("2022-03-01 00:00:00", None),
    ("2022-03-01 00:00:00", 120.0),
    ("2022-03-01 10:00:00", 115.7),
    ("2022-03-01 10:00:00", 105.8),
    ("2022-03-01 10:00:00", 110.9),
    ("2022-03-01 10:00:00", 90.0),
    ("2022-03-01 00:00:00", 97.0),
    ("2022-03-01 00:00:00", 200.0),
]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(scratch / "shared"))
        .config("spark.sql.warehouse.dir", str(scratch / "warehouse"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


def turbine_rows(spark, rows):
    """Rows of (time, turbine, wind speed, wind direction, power) as parsed raw readings of one file."""
    columns = "timestamp STRING, turbine_id INT, wind_speed DOUBLE, wind_direction BIGINT, power_output DOUBLE"
    df = spark.createDataFrame(rows, columns)
    return df.withColumn("timestamp", F.col("timestamp").cast("timestamp")).withColumn(
        "filename", F.lit("test.csv")
    )


@pytest.fixture
def sample(spark):
    return turbine_rows(spark, [(time, 1, 11.8, 169, power) for time, power in SAMPLE])


def readings(spark, rows):
    """Rows of (sensor, value), numbered."""
    numbered = [(i, *row) for i, row in enumerate(rows)]
    return spark.createDataFrame(numbered, "id INT, sensor STRING, value DOUBLE")


def five_turbines(path, files=1, readings_each=4, broken=()):
    """CSV files with a header, each with five turbines and no reading beyond two deviations."""
    path.mkdir(parents=True, exist_ok=True)
    for number in range(files):
        lines = ["timestamp,turbine_id,wind_speed,wind_direction,power_output"]
        for turbine in range(1, 6):
            for i in range(readings_each):
                lines.append(f"2022-03-0{number + 1}T{i:02d}:00:00,{turbine},11.{i},169,{100 + turbine + i}.5")
        (path / f"group_{number}.csv").write_text("\n".join([*lines, *broken]) + "\n")
    return str(path)
