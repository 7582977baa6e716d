"""Where intermediate results live: the shared folder the cluster names in `spark.checkpoint.dir`."""

from __future__ import annotations

import json
import re
import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder, reachable from every executor.

    If the cluster names none, a local-mode session gets a temporary folder; anywhere else that folder
    would not be shared, so this is an error.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):  # not local-cluster, whose executors are apart
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="bandwright-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used before."""
    return f"{shared_folder(spark).rstrip('/')}/bandwright/{name}-{uuid4().hex}"


def _at(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def stage(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Computed once and kept as a Parquet table in the shared folder, of which later plans read the columns they need;
    and where it lies.

    The table goes when the application ends, or before that by `remove`.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    # Not the default codec, whose buffers lie outside the heap until they are collected.
    df.write.option("compression", "zstd").parquet(path)
    files, place = _at(spark, path)
    files.deleteOnExit(place)
    return spark.read.schema(df.schema).parquet(path), path


def staged(df: DataFrame, name: str) -> DataFrame:
    """The frame of `stage`, to be kept until the application ends."""
    return stage(df, name)[0]


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder or file that nothing reads any more."""
    files, place = _at(spark, path)
    files.delete(place, True)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder, sorted; none if it does not exist."""
    files, place = _at(spark, path)
    return sorted(status.getPath().getName() for status in files.listStatus(place)) if files.exists(place) else []


def read_note(spark: SparkSession, path: str) -> dict | None:
    """A small JSON document, read by the driver without a job; None if there is none."""
    files, place = _at(spark, path)
    if not files.exists(place):
        return None
    stream = files.open(place)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def write_note(spark: SparkSession, path: str, note: dict) -> None:
    """Write a small JSON document. It appears under its name whole: it is written beside it and renamed."""
    files, place = _at(spark, path)
    _, beside = _at(spark, f"{path}.{uuid4().hex}.tmp")
    stream = files.create(beside, True)
    try:
        stream.write(bytearray(json.dumps(note).encode()))
    finally:
        stream.close()
    if files.exists(place):
        files.delete(place, False)
    if not files.rename(beside, place):
        files.delete(beside, False)
        raise RuntimeError(f"could not write {path}")


def files_in(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Files below a folder that a scan would read, with the time of their last change in milliseconds."""
    files, place = _at(spark, path)
    found, listed = [], files.listFiles(place, True) if files.exists(place) else None
    while listed is not None and listed.hasNext():
        status = listed.next()
        if not status.getPath().getName().startswith(("_", ".")):
            found.append((status.getPath().toUri().toString(), status.getModificationTime()))
    return found


def touch(spark: SparkSession, uri: str, at: int) -> None:
    """Set the time of a file's last change, in milliseconds."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(spark.sparkContext._jvm.java.net.URI(uri))
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).setTimes(place, at, -1)
