"""Contracts and column roles for wind power readings."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql.types import StructType

from .contracts import DatasetContract
from .spec import ReadingSpec


def _schema(columns: Mapping[str, str]) -> StructType:
    schema = StructType()
    for name, kind in columns.items():
        schema = schema.add(name, kind)
    return schema


# Column names, order and types of the stored datasets, and the default parameters.
RAW_COLUMNS = _schema(
    {
        "timestamp": "timestamp",
        "turbine_id": "integer",
        "wind_speed": "double",
        "wind_direction": "long",
        "power_output": "double",
    }
)
REJECTED_COLUMNS = _schema(
    {
        "timestamp": "timestamp",
        "turbine_id": "integer",
        "wind_speed": "double",
        "wind_direction": "long",
        "power_output": "double",
        "year": "integer",
        "month": "integer",
        "day": "integer",
        "insert_timestamp": "timestamp",
        "filename": "string",
    }
)
ANOMALY_COLUMNS = _schema(
    {
        "timestamp": "timestamp",
        "turbine_id": "integer",
        "power_output": "double",
        "mean_power": "double",
        "stddev_power": "double",
        "wind_speed": "double",
        "wind_direction": "long",
        "filename": "string",
        "year": "integer",
        "month": "integer",
        "day": "integer",
        "insert_timestamp": "timestamp",
    }
)
CLEANED_COLUMNS = _schema(
    {
        "timestamp": "timestamp",
        "turbine_id": "integer",
        "wind_speed": "double",
        "wind_direction": "long",
        "power_output": "double",
        "filename": "string",
        "year": "integer",
        "month": "integer",
        "day": "integer",
        "insert_timestamp": "timestamp",
    }
)
STATS_COLUMNS = _schema(
    {
        "turbine_id": "integer",
        "start": "timestamp",
        "end": "timestamp",
        "min_power": "double",
        "max_power": "double",
        "avg_power": "double",
        "stddev_power": "double",
        "year": "integer",
        "month": "integer",
        "day": "integer",
        "insert_timestamp": "timestamp",
    }
)
COMPLETENESS_COLUMNS = _schema(
    {
        "filename": "string",
        "unique_turbine_count": "long",
        "is_valid": "boolean",
        "year": "integer",
        "month": "integer",
        "day": "integer",
        "insert_timestamp": "timestamp",
    }
)
THRESHOLD = 2
WINDOW = "24 hours"
TURBINES_PER_FILE = 5
VALID_TIMESTAMP = {"valid timestamp": "timestamp > '2012-01-01'"}
DEFAULT_FORMATS = {"cleaned": "jdbc", "stats": "jdbc", "anomalies": "csv", "rejected": "csv"}

_COLUMNS = {
    "cleaned": CLEANED_COLUMNS,
    "stats": STATS_COLUMNS,
    "anomalies": ANOMALY_COLUMNS,
    "rejected": REJECTED_COLUMNS,
    "completeness": COMPLETENESS_COLUMNS,
}


def wind_power_spec(**changes) -> ReadingSpec:
    """Column roles and default parameters of wind power readings; keywords override single fields."""
    settings = dict(
        key="turbine_id",
        ts="timestamp",
        value="power_output",
        context=("wind_speed", "wind_direction"),
        group="filename",
        k=THRESHOLD,
        window=WINDOW,
        expected_keys=TURBINES_PER_FILE,
        label="power",
        count_name="unique_turbine_count",
        anomaly_columns=tuple(ANOMALY_COLUMNS.names),
        schema=RAW_COLUMNS,
    )
    return ReadingSpec(**(settings | changes))


def raw_contract(path: str) -> DatasetContract:
    return DatasetContract("raw", RAW_COLUMNS, "csv", {"path": path, "header": "true"}, partition_by=())


def wind_power_contracts(
    options: Mapping[str, Mapping[str, str]], formats: Mapping[str, str] = DEFAULT_FORMATS
) -> dict[str, DatasetContract]:
    """The output contracts. `options` holds the connection options of each, `formats` its format. Completeness has
    one only if it has options."""
    return {
        name: DatasetContract(name, columns, formats.get(name, "csv"), options[name])
        for name, columns in _COLUMNS.items()
        if name in options or name != "completeness"
    }
