"""Dataset contracts: the columns, storage format and connection options of one stored dataset."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from .functions.audit import LOAD_DATE
from .functions.checks import require_columns, require_frame

FILE_FORMATS = ("csv", "parquet", "delta")
FORMATS = (*FILE_FORMATS, "jdbc")
JDBC_OPTIONS = ("driver", "url", "dbtable", "user", "password")


class ContractError(ValueError):
    """A frame or an option set does not meet its contract."""


@dataclass(frozen=True)
class DatasetContract:
    """`schema` may be a DDL string if a session is running.

    `options` go to Spark's reader and writer as they are, so they may hold tuning options as well.

    File formats need `path`. JDBC needs driver, url, dbtable, user and password; `username` is accepted
    for `user`. JDBC ignores `partition_by`.
    """

    name: str
    schema: StructType | str
    format: str
    options: Mapping[str, str] = field(default_factory=dict, repr=False)
    partition_by: tuple[str, ...] = LOAD_DATE

    def __post_init__(self):
        schema = StructType.fromDDL(self.schema) if isinstance(self.schema, str) else self.schema
        options = dict(self.options)
        if "username" in options:
            options.setdefault("user", options.pop("username"))
        object.__setattr__(self, "schema", schema)
        object.__setattr__(self, "options", options)
        if self.format not in FORMATS:
            raise ContractError(f"{self.name}: unsupported format {self.format!r}, use one of {', '.join(FORMATS)}")
        needed = JDBC_OPTIONS if self.format == "jdbc" else ("path",)
        absent = [name for name in needed if not options.get(name)]
        if absent:
            raise ContractError(f"{self.name}: missing {self.format} options: {', '.join(absent)}")
        strangers = sorted(set(self.partition_by) - set(schema.names))
        if strangers and self.format != "jdbc":
            raise ContractError(f"{self.name}: partition columns not in the schema: {', '.join(strangers)}")

    @property
    def path(self) -> str:
        return self.options["path"]

    def differences(self, df: DataFrame) -> list[str]:
        """What keeps `df` from meeting the contract: number of columns, then name and type by position.

        Nullability is not compared. Reads the schema only.
        """
        require_frame(df)
        have, want = df.schema.fields, self.schema.fields
        if len(have) != len(want):
            extra = sorted(set(df.columns) - set(self.schema.names))
            lacking = sorted(set(self.schema.names) - set(df.columns))
            return [
                f"expected {len(want)} columns, got {len(have)}",
                *(f"unexpected column {name}" for name in extra),
                *(f"missing column {name}" for name in lacking),
            ]
        return [
            f"column {i}: expected {w.name} {w.dataType.simpleString()}, got {h.name} {h.dataType.simpleString()}"
            for i, (h, w) in enumerate(zip(have, want), start=1)
            if (h.name, h.dataType) != (w.name, w.dataType)
        ]

    def verify(self, df: DataFrame) -> None:
        found = self.differences(df)
        if found:
            raise ContractError(f"{self.name}: " + "; ".join(found))

    def conform(self, df: DataFrame) -> DataFrame:
        """The contract's columns in the contract's order; further columns are dropped."""
        require_columns(df, self.schema.names)
        return df.select(*self.schema.names)
