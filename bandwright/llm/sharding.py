"""Cut a corpus into shards that all have its mixture of sources, by proportional stratified interleaving.

Rows of a source are put into a seeded random order and numbered; the i-th of n rows stands at (i + p) / n, where p,
between 0 and 1, is drawn once for the source. Sorted by that fraction, every stretch of the corpus holds each source in
proportion, so equal cuts make equal shards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import group_key, running, shielded, uniform, unshielded


def text_bytes(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def text_crc32(text: Column) -> Column:
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def interleave(
    docs: DataFrame,
    shards: int = 8,
    text: str = "text",
    source: str = "source",
    doc_id: str = "doc_id",
    seed: int = 42,
) -> DataFrame:
    """All rows with `size` (bytes of the text plus 1), `text_crc32`, `shard` and `slot`.

    * Numbers of rows in two shards differ by at most one, and so do those of each source, but for the rows of other
      sources that share a boundary. Slots of a shard count from 0 without gaps, in interleaved order.
    * The random order depends on `doc_id`, size, checksum and `seed`, so rows without an id, or of the same one, are
      spread like others; rows of a source that are equal in all of them are interchangeable.
    * A NULL source is a source of its own, a NULL text has no bytes and checksum 0. Fewer rows than shards leave
      shards empty. An input column named like an output gives way to it.

    Rows are shuffled twice: by source and stretch of the random order, then by stretch of the corpus. A source with most
    of the rows is ordered in as many stretches as any other, and very many small sources are spread by their p. Only
    repeated rows (source, id, size and checksum alike) stay together in one stretch.
    """
    if shards < 1:
        raise ValueError(f"shards must be at least 1, not {shards}")
    inner, names = shielded(docs, text, source, doc_id)
    key, body = F.col(names[doc_id]), F.col(names[text])
    rows = inner.select(
        "*",
        group_key(F.col(names[source])).alias("g"),
        key.cast("string").alias("name"),
        text_bytes(body).alias("size"),
        text_crc32(body).alias("crc"),
    )
    drawn = F.concat_ws(":", F.coalesce("name", F.lit("null")), "size", "crc")
    rows = rows.withColumn("u", uniform(drawn, seed))
    shuffled = [F.col("u"), key, F.col("crc"), F.col("size")]
    inside = running(rows, "g", F.col("u"), shuffled, F.lit(1), "source")
    at = (F.col("source_before") + uniform(F.col("g"), seed)) / F.col("source_total")
    spread = inside.select("*", at.alias("at"), F.lit("").alias("all"))
    placed = running(spread, "all", F.col("at"), [F.col("at"), F.col("g"), F.col("source_before")], F.lit(1), "row")
    shard = F.expr(f"CAST((row_before * {shards}) div row_total AS INT)")
    outputs = {
        "size": F.col("size"),
        "text_crc32": F.col("crc"),
        "shard": shard,
        "slot": F.expr(f"row_before - ((((row_before * {shards}) div row_total) * row_total + {shards - 1}) div {shards})"),
    }
    return unshielded(placed, docs.columns, outputs)


def write_shards(docs: DataFrame, path: str, shards: int = 8, mode: str = "errorifexists", **options) -> None:
    """Write one folder `shard=k` per shard, rows in slot order within a file."""
    placed = interleave(docs, shards, **options)
    placed.repartitionByRange(F.col("shard"), F.col("slot")).sortWithinPartitions("shard", "slot").write.mode(
        mode
    ).partitionBy("shard").parquet(path)
