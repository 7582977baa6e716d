"""What a table of readings looks like and how it is to be judged."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import StructType

from .functions.checks import require_duration, require_positive


@dataclass(frozen=True)
class ReadingSpec:
    """Column roles and parameters of one kind of readings; every plan takes one of these.

    `label` names the value in derived columns (`mean_<label>`, `min_<label>`, …); default: the value column.
    `anomaly_columns` lists the columns of the anomaly output in order; default: all, then the statistics.
    `context` names further columns that the input must have.
    """

    key: str
    ts: str
    value: str
    context: tuple[str, ...] = ()
    group: str = "filename"
    k: float = 2.0
    window: str = "24 hours"
    expected_keys: int = 5
    label: str | None = None
    count_name: str = "distinct_keys"
    anomaly_columns: tuple[str, ...] | None = None
    schema: StructType | str | None = None
    corrupt_column: str | None = None
    on_undefined: str = "drop"
    zero_band: str = "constant"
    nan_is_null: bool = True

    def __post_init__(self):
        require_positive("k", self.k)
        require_positive("expected_keys", self.expected_keys)
        require_duration("window", self.window)

    @property
    def required(self) -> tuple[str, ...]:
        return (self.key, self.value, self.ts, *self.context)

    def judged_columns(self, columns: list[str]) -> list[str]:
        """The columns whose absence makes a row incomplete: all but the one that holds unparsable text."""
        return [name for name in columns if name != self.corrupt_column]
