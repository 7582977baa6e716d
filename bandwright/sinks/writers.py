"""Contract-driven sinks."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession

from ..contracts import ContractError, DatasetContract
from ..functions.audit import LOAD_DATE
from ..functions.checks import require_choice, require_frame, require_rows
from ..storage import remove
from .formats import CSV_TIME_FORMATS

RUN = "run_id"
MODES = ("append", "overwrite", "ignore", "error", "errorifexists")


class UnavailableFormatError(RuntimeError):
    """The storage format's connector is not on the class path."""


def _save(writer: DataFrameWriter, fmt: str, mode: str, options: Mapping[str, str]) -> None:
    require_choice("mode", mode, MODES)
    try:
        writer.format(fmt).options(**options).mode(mode).save()
    except (AnalysisException, Py4JJavaError) as problem:
        if "[DATA_SOURCE_NOT_FOUND]" in str(problem):
            raise UnavailableFormatError(f"no connector for format {fmt!r} on the class path") from problem
        raise


def _save_files(
    df: DataFrame, fmt: str, path: str, mode: str, partition_by: Sequence[str], options: Mapping[str, str]
) -> None:
    if not path:
        raise ValueError("a path is required")
    _save(df.write.partitionBy(*partition_by), fmt, mode, {**options, "path": path})


def write_csv(
    df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = LOAD_DATE, **options
) -> None:
    """CSV files without a header, one folder per partition, timestamps to the microsecond."""
    _save_files(df, "csv", path, mode, partition_by, {**CSV_TIME_FORMATS, **options})


def write_parquet(
    df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = LOAD_DATE, **options
) -> None:
    _save_files(df, "parquet", path, mode, partition_by, options)


def write_delta(
    df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = LOAD_DATE, **options
) -> None:
    """Needs the Delta connector on the class path."""
    _save_files(df, "delta", path, mode, partition_by, options)


def write_jdbc(
    df: DataFrame, driver: str, url: str, dbtable: str, user: str, password: str, mode: str = "append", **options
) -> None:
    """Insert into a database table.

    Each task inserts in its own transaction, so a retried task may repeat rows that were committed just
    before it was lost. The option `numPartitions` bounds the number of connections.
    """
    needed = {"driver": driver, "url": url, "dbtable": dbtable, "user": user, "password": password}
    absent = [name for name, value in needed.items() if not value]
    if absent:
        raise ValueError(f"missing JDBC options: {', '.join(absent)}")
    _save(df.write, "jdbc", mode, {**options, **needed})


WRITERS: dict[str, Callable[..., None]] = {
    "csv": write_csv,
    "parquet": write_parquet,
    "delta": write_delta,
    "jdbc": write_jdbc,
}


def write_contract(
    df: DataFrame,
    contract: DatasetContract,
    mode: str = "overwrite",
    *,
    require_non_empty: bool = False,
    dynamic_overwrite: bool = False,
    rebalance: bool = False,
    run_id: str | None = None,
) -> None:
    """Check a frame against its contract and write it to the contract's sink.

    `require_non_empty` refuses an empty frame, at the price of a limit-1 job.
    `dynamic_overwrite` makes overwrite replace only the partitions that `df` holds rows for.
    `rebalance` lets adaptive execution merge the output into files of its advisory size: for results that
    are a small part of a large scan, which would otherwise leave a tiny file per task.
    `run_id` makes append repeatable: the rows go to the dataset's folder `run_id=<run_id>`, in place of what a former
    try of the same run left there. A dataset is written either with run names or without.
    """
    require_frame(df)
    if contract is None:
        raise ValueError("a contract is required")
    require_choice("mode", mode, MODES)
    contract.verify(df)
    if require_non_empty:
        require_rows(df, f"{contract.name}: the frame to write is empty")
    if rebalance:
        df = df.hint("rebalance")
    options = dict(contract.options)
    if run_id is not None:
        if mode != "append" or dynamic_overwrite:
            raise ValueError("a run name is for mode append")
        options["path"], mode = _run_folder(contract, run_id), "overwrite"
    if contract.format != "jdbc":
        options["partition_by"] = contract.partition_by
        if dynamic_overwrite:
            options["partitionOverwriteMode"] = "dynamic"
    elif dynamic_overwrite:
        raise ContractError(f"{contract.name}: a JDBC table has no partitions to overwrite")
    WRITERS[contract.format](df, mode=mode, **options)


def _run_folder(contract: DatasetContract, run_id: str) -> str:
    if contract.format not in ("csv", "parquet"):
        raise ContractError(f"{contract.name}: a {contract.format} table has no folder for each run")
    if not re.fullmatch(r"[A-Za-z0-9._-]+", run_id):
        raise ValueError(f"a run name is letters, digits, '.', '_' and '-', not {run_id!r}")
    return f"{contract.path.rstrip('/')}/{RUN}={run_id}"


def withdraw_run(spark: SparkSession, contract: DatasetContract, run_id: str) -> None:
    """Remove what a run wrote to a dataset; nothing if it wrote nothing."""
    remove(spark, _run_folder(contract, run_id))
