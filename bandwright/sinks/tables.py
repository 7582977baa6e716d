"""Named tables: a comment, partition columns and, optionally, a folder of their own."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from ..functions.audit import LOAD_DATE


def _literal(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


@dataclass(frozen=True)
class ManagedTable:
    """`name` may be qualified by a database. With `path` the files live there, else in the warehouse."""

    name: str
    comment: str = ""
    partition_by: tuple[str, ...] = LOAD_DATE
    path: str | None = None
    format: str = "parquet"

    def _quoted(self) -> str:
        return ".".join(f"`{part}`" for part in self.name.split("."))

    def _describe(self, spark: SparkSession) -> None:
        spark.sql(f"COMMENT ON TABLE {self._quoted()} IS '{_literal(self.comment)}'")

    def save(self, df: DataFrame, mode: str = "overwrite") -> None:
        """Write a batch frame and record the comment."""
        writer = df.write.format(self.format).mode(mode).partitionBy(*self.partition_by)
        if self.path:
            writer = writer.option("path", self.path)
        writer.saveAsTable(self.name)
        self._describe(df.sparkSession)

    def create(self, spark: SparkSession, schema) -> None:
        """Register the table, empty or over the files already in its folder, so that a stream can append."""
        if not spark.catalog.tableExists(self.name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
            partitions = ", ".join(f"`{name}`" for name in self.partition_by)
            spark.sql(
                f"CREATE TABLE {self._quoted()} ({columns}) USING {self.format}"
                + (f" PARTITIONED BY ({partitions})" if partitions else "")
                + (f" LOCATION '{_literal(self.path)}'" if self.path else "")
            )
        self._describe(spark)

    def point(self, spark: SparkSession, schema) -> None:
        """Let the name stand for the files in this table's folder from now on; its columns stay those it was made with."""
        if spark.catalog.tableExists(self.name):
            spark.sql(f"ALTER TABLE {self._quoted()} SET LOCATION '{_literal(self.path)}'")
            tracked = spark.conf.get("spark.sql.hive.manageFilesourcePartitions") == "true"
            if self.partition_by and tracked and self.format != "delta":
                # The catalogue's partitions still lead to the former folder.
                for row in spark.sql(f"SHOW PARTITIONS {self._quoted()}").collect():
                    parts = (part.split("=", 1) for part in row.partition.split("/"))
                    named = ", ".join(f"`{name}` = '{_literal(value)}'" for name, value in parts)
                    spark.sql(f"ALTER TABLE {self._quoted()} DROP IF EXISTS PARTITION ({named})")
        self.create(spark, schema)
        self.refresh(spark)

    def refresh(self, spark: SparkSession) -> None:
        """Make files known that were written to the folder directly: a catalogue keeps a list of partitions."""
        tracked = spark.conf.get("spark.sql.hive.manageFilesourcePartitions") == "true"
        if self.partition_by and tracked and self.format != "delta":
            spark.catalog.recoverPartitions(self._quoted())
        spark.catalog.refreshTable(self._quoted())

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.table(self.name)
