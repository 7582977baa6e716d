"""File and table sources. Schemas are always declared, never inferred."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..contracts import DatasetContract
from ..functions.checks import require_positive
from ..sinks.formats import CSV_TIME_FORMATS
from ..storage import files_in, touch

#: Older than any file.
ANY_AGE = "36500d"
#: For so long a stream that archives its files remembers their names.
REMEMBER_DAYS = 7


def _declared(schema: StructType | str, corrupt_column: str | None) -> StructType:
    fields = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if corrupt_column and corrupt_column not in fields.names:
        fields = StructType([*fields.fields, StructField(corrupt_column, StringType(), True)])
    return fields


def _csv_options(header: bool, corrupt_column: str | None, options: dict) -> dict:
    corrupt = {"columnNameOfCorruptRecord": corrupt_column} if corrupt_column else {}
    return {"header": header, "mode": "PERMISSIVE", **corrupt, **options}


def _check(path: str, schema: object) -> None:
    if not path:
        raise ValueError("a path is required")
    if not schema:
        raise ValueError("a schema is required")


def _with_lineage(df: DataFrame, file_column: str | None) -> DataFrame:
    return df.withColumn(file_column, F.col("_metadata.file_path")) if file_column else df


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    *,
    header: bool = True,
    file_column: str | None = "filename",
    corrupt_column: str | None = None,
    **options,
) -> DataFrame:
    """Read a CSV file or folder under a declared schema and note each row's source file.

    A field that does not parse, or is absent, becomes NULL and the other fields survive. `corrupt_column`
    keeps the text of such lines. Further keywords are Spark's CSV options.
    """
    _check(path, schema)
    reader = spark.read.options(**_csv_options(header, corrupt_column, options))
    return _with_lineage(reader.schema(_declared(schema, corrupt_column)).csv(path), file_column)


def stream_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    *,
    header: bool = True,
    file_column: str | None = "filename",
    corrupt_column: str | None = None,
    archive_dir: str | None = None,
    remember_days: int = REMEMBER_DAYS,
    **options,
) -> DataFrame:
    """The same rows as `read_csv`, as a stream of newly arrived files.

    `maxFilesPerTrigger` or `maxBytesPerTrigger` bound one micro-batch. No file is too old to be read: Spark by itself
    passes over files a week older than the newest one. The stream therefore remembers every file name.

    With `archive_dir` files leave for that folder (outside `path`) some time after they were read, and names are
    remembered for `remember_days` only. Files that arrive with an older time of change are then passed over, unless
    `admit_late_files` is called before the stream starts, as `run_incremental` does.
    """
    _check(path, schema)
    options = {"maxFileAge": ANY_AGE, **options}
    if archive_dir:
        require_positive("remember_days", remember_days)
        options |= {"cleanSource": "archive", "sourceArchiveDir": archive_dir, "maxFileAge": f"{remember_days}d"}
    reader = spark.readStream.options(**_csv_options(header, corrupt_column, options))
    return _with_lineage(reader.schema(_declared(schema, corrupt_column)).csv(path), file_column)


def admit_late_files(
    spark: SparkSession, path: str, seen: DataFrame | None, file_column: str, remember_days: int = REMEMBER_DAYS
) -> list[str]:
    """Make files known that have arrived with a time of change beyond what the stream remembers; return their names.

    Files of that age that are still in the folder either wait to be archived, and then `seen`, the rows taken in so far,
    has their names; or they were never read, and get the present time. Only names of such files are looked up.
    """
    found = files_in(spark, path)
    if not found:
        return []
    day, newest = 24 * 3600 * 1000, max(at for _, at in found)
    # A day's margin: what the stream still remembers need not be touched.
    old = [name for name, at in found if at < newest - (remember_days - 1) * day or at < _now() - (remember_days - 1) * day]
    if seen is not None and old:
        known = seen.where(F.col(file_column).isin(old)).select(file_column).distinct().collect()
        old = sorted(set(old) - {row[0] for row in known})
    for name in old:
        touch(spark, name, _now())
    return old


def _now() -> int:
    return int(time.time() * 1000)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """All rows of a managed table, as a batch frame."""
    return spark.read.table(name)


def read_contract(spark: SparkSession, contract: DatasetContract) -> DataFrame:
    """Read a stored dataset back with the types and column order of its contract.

    Partition columns come back from the folder names and JDBC may change types, hence the casts.
    """
    if contract.format == "jdbc":
        stored = spark.read.format("jdbc").options(**contract.options).load()
    else:
        options = CSV_TIME_FORMATS if contract.format == "csv" else {}
        reader = spark.read.options(**{**options, **contract.options})
        if contract.format != "delta":
            reader = reader.schema(contract.schema)
        stored = reader.format(contract.format).load()
    return stored.select(*(F.col(f.name).cast(f.dataType) for f in contract.schema.fields))
