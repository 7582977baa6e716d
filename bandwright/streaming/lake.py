"""Where the tables of the graph lie, and which version of them readers see.

`root/_versions` holds numbered notes, each of which says for every table in which folder it is and what columns it has.
Readers take the newest note, so all tables change at once and an empty table has its columns. A note is never changed;
the one before the newest and its folders stay, for readers that have begun.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..functions.audit import LOAD_DATE
from ..sinks.tables import ManagedTable
from ..storage import names_in, read_note, remove, write_note

BRONZE = "bronze"
BATCH_ID = "batch_id"
LEDGER = "_ledger"
COMMENTS = {
    BRONZE: "Readings as ingested, with load columns",
    "cleaned": "Complete readings inside the band of their entity",
    "stats": "Statistics of the cleaned readings per entity and time window",
    "anomalies": "Readings outside the band of their entity",
    "rejected": "Readings with a missing value",
    "completeness": "Distinct entities per group of readings",
}
_VERSIONS = "_versions"
_NOTE = "batch_id LONG, loaded STRING, violations MAP<STRING, LONG>"


@dataclass(frozen=True)
class Version:
    """A state of the lake: folder (below the root) and schema of each table, and notes of the flow that wrote it."""

    number: int = 0
    tables: Mapping[str, Mapping] = field(default_factory=dict)
    notes: Mapping[str, object] = field(default_factory=dict)

    def folders(self) -> set[str]:
        kept = {entry["folder"] for entry in self.tables.values()}
        return kept | {note["folder"] for note in self.notes.values() if isinstance(note, dict) and "folder" in note}


@dataclass(frozen=True)
class Lake:
    """Tables in folders below `root`, and named tables if a database is given.

    `format` may be any file format that takes overwriting by partition, such as delta where its connector is there.
    One writer at a time.
    """

    root: str
    database: str | None = None
    format: str = "parquet"
    comments: Mapping[str, str] = field(default_factory=lambda: dict(COMMENTS))

    def path(self, folder: str) -> str:
        return f"{self.root.rstrip('/')}/{folder}"

    def checkpoint(self, name: str) -> str:
        return self.path(f"_checkpoints/{name}")

    def table(self, name: str, partition_by: tuple[str, ...] = LOAD_DATE, folder: str | None = None) -> ManagedTable | None:
        if self.database is None:
            return None
        return ManagedTable(
            f"{self.database}.{name}", self.comments.get(name, ""), partition_by, self.path(folder or name), self.format
        )

    def version(self, spark: SparkSession) -> Version:
        """What readers see now."""
        notes = [name for name in names_in(spark, self.path(_VERSIONS)) if name.endswith(".json")]
        if not notes:
            return Version()
        note = read_note(spark, self.path(f"{_VERSIONS}/{notes[-1]}"))
        return Version(int(notes[-1].removesuffix(".json")), note["tables"], note["notes"])

    def publish(
        self,
        spark: SparkSession,
        tables: Mapping[str, tuple[str, StructType]],
        notes: Mapping[str, object] | None = None,
        seen: Version | None = None,
    ) -> Version:
        """Let readers see these tables (name: folder and columns) from now on; others stay as they are."""
        before = seen or self.version(spark)
        entries = {name: {"folder": folder, "schema": schema.jsonValue()} for name, (folder, schema) in tables.items()}
        now = Version(before.number + 1, {**before.tables, **entries}, {**before.notes, **(notes or {})})
        if (now.tables, now.notes) == (before.tables, before.notes):
            return before
        write_note(spark, self._note(now.number), {"tables": dict(now.tables), "notes": dict(now.notes)})
        self._drop(spark, before.folders() | now.folders(), before.number)
        return now

    def _note(self, number: int) -> str:
        return self.path(f"{_VERSIONS}/{number:012d}.json")

    def _drop(self, spark: SparkSession, kept: set[str], oldest: int) -> None:
        """Remove the notes before `oldest`, and folders that only they name."""
        for name in names_in(spark, self.path(_VERSIONS)):
            number = name.removesuffix(".json")
            if not number.isdigit() or int(number) >= oldest:
                continue
            note = read_note(spark, self.path(f"{_VERSIONS}/{name}"))
            for folder in Version(0, note["tables"], note["notes"]).folders() - kept:
                remove(spark, self.path(folder))
            remove(spark, self.path(f"{_VERSIONS}/{name}"))

    def fresh_folder(self, name: str) -> str:
        return f"{name}/v-{uuid4().hex}"

    def read(self, spark: SparkSession, name: str, version: Version | None = None) -> DataFrame:
        """All published rows of a table as a batch frame; an empty table has its columns too."""
        entry = (version or self.version(spark)).tables.get(name)
        reader = spark.read.format(self.format)
        if entry is None:
            return reader.load(self.path(name))
        if self.format != "delta":
            reader = reader.schema(StructType.fromJson(entry["schema"]))
        return reader.load(self.path(entry["folder"]))

    # The ledger: what each micro-batch did, under its number.

    def record(self, spark: SparkSession, query: str, batch_id: int, **facts) -> None:
        """Note facts of a micro-batch, in place of what an earlier try of it noted."""
        write_note(spark, self.path(f"{LEDGER}/{query}/{batch_id:012d}.json"), {"batch_id": batch_id, **facts})

    def recorded(self, spark: SparkSession, query: str, batch_id: int) -> dict:
        return read_note(spark, self.path(f"{LEDGER}/{query}/{batch_id:012d}.json")) or {}

    def violations(self, spark: SparkSession, query: str, batches: Iterable[int]) -> dict[str, int]:
        """Expectation counts of some micro-batches, added up."""
        total: dict[str, int] = {}
        for batch_id in batches:
            for rule, count in self.recorded(spark, query, batch_id).get("violations", {}).items():
                total[rule] = total.get(rule, 0) + count
        return total

    def ledger(self, spark: SparkSession) -> DataFrame:
        """Expectation counts of all micro-batches ever judged: `query`, `batch_id`, `rule`, `violations`."""
        folder = self.path(LEDGER)
        if not names_in(spark, folder):
            return spark.createDataFrame([], "query STRING, batch_id LONG, rule STRING, violations LONG")
        notes = spark.read.schema(_NOTE).option("pathGlobFilter", "*.json").json(f"{folder}/*")
        query = F.element_at(F.split("_metadata.file_path", "/"), -2)
        return notes.select(query.alias("query"), "batch_id", F.explode("violations").alias("rule", "violations"))
