"""Helpers the operators of this package share.

`shielded` renames columns by position, so no column an operator adds can clash with one of the input, whatever
the input's names are (repeated names included).

`running` gives each row the sum of what precedes it in its group. The group is cut into buckets of the sort
position first, so the largest group is ordered by many tasks and only one row per bucket meets in one place.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.checks import require_columns
from ..storage import remove, shared_folder, stage, staged

WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\f\r"
BUCKETS = 1024
BROADCAST_BYTES = 16 * 1024 * 1024
SALTS = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def package_on_workers(spark: SparkSession) -> None:
    """Let Python workers that share the driver's files find this package beside it. A cluster gets it by `--py-files`
    or as an installed package, as any other."""
    environment = spark.sparkContext.environment
    root = str(Path(__file__).resolve().parents[2])
    known = [path for path in environment.get("PYTHONPATH", "").split(":") if path]
    if root not in known:
        environment["PYTHONPATH"] = ":".join([root, *known])


def arrow_function(of: Callable, kind: str) -> Callable[[Column], Column]:
    """A function from Arrow array to Arrow array as a column function."""
    package_on_workers(SparkSession.active())
    return F.arrow_udf(of, kind)


def blocks_of(column: pa.Array, size: int) -> Iterator[list[str]]:
    """The texts in order, in blocks of about `size` characters; NULL as an empty text."""
    held, texts = 0, []
    for i, value in enumerate(column):
        texts.append(value.as_py() or "")
        held += len(texts[-1])
        if held >= size or i + 1 == len(column):
            yield texts
            held, texts = 0, []


def shielded(df: DataFrame, *required: str) -> tuple[DataFrame, dict[str, str]]:
    """The frame with columns c0, c1, ... and where each original name went (its first place if repeated)."""
    require_columns(df, required)
    names: dict[str, str] = {}
    for i, name in enumerate(df.columns):
        names.setdefault(name, f"c{i}")
    return df.toDF(*(f"c{i}" for i in range(len(df.columns)))), names


def unshielded(inner: DataFrame, names: Sequence[str], outputs: Mapping[str, Column]) -> DataFrame:
    """The original columns under their names, then `outputs`; an input column named like an output gives way."""
    taken = {name.lower() for name in outputs}
    kept = [F.col(f"c{i}").alias(name) for i, name in enumerate(names) if name.lower() not in taken]
    return inner.select(*kept, *(column.alias(name) for name, column in outputs.items()))


def held(df: DataFrame) -> DataFrame:
    """Computed once and kept in the shared checkpoint folder, so that later plans start there."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def words(text: Column) -> Column:
    """The words of a text; none if it is NULL."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def group_key(column: Column) -> Column:
    """A string that is never NULL and differs for different values; NULL sorts last."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit("~"))


def uniform(column: Column, seed: int) -> Column:
    """A number in (0, 1) that only the value and the seed decide, the same in any engine that has MD5."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(column.cast("string"), F.lit("null"))).cast("binary"))
    number = F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")
    return (number.cast("double") + 0.5) / float(2**52)


def attach(rows: DataFrame, facts: DataFrame, key: str, salt: Column) -> DataFrame:
    """Inner join of `rows` with a (held) table of one row per `key`.

    Its size is measured. A table within `BROADCAST_BYTES` is broadcast; a larger one is repeated once per salt,
    so that a key with most of the rows is spread over as many tasks.
    """
    size = facts.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(key)).alias("b")).first()
    width = 16 * len(facts.columns) + 64
    if size.n * width + 2 * (size.b or 0) <= BROADCAST_BYTES:
        return rows.join(F.broadcast(facts), key)
    spread = facts.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = rows.withColumn("__salt", F.pmod(F.xxhash64(salt), F.lit(SALTS)).cast("int"))
    return salted.join(spread, [key, "__salt"]).drop("__salt")


def running(
    df: DataFrame, group: str, position: Column, order: Sequence[Column], amount: Column, name: str
) -> DataFrame:
    """Add `{name}_before`, the sum of `amount` over the rows that precede in the group, and `{name}_total`.

    `position` in [0, 1) must not decrease along `order`; it cuts each group into buckets of which every task
    orders some. `group` must not be NULL, `amount` must be a whole number. Shuffles: per-task partial sums, at
    most `BUCKETS` rows per group, and the rows once.
    """
    bucket = F.least(F.floor(position * BUCKETS), F.lit(BUCKETS - 1)).cast("int")
    rows = df.withColumn("__bucket", bucket).withColumn("__amount", amount.cast("long"))
    sums = rows.groupBy(group, "__bucket").agg(F.sum("__amount").alias("__sum"))
    whole = Window.partitionBy(group)
    earlier = whole.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        group,
        "__bucket",
        F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__offset"),
        F.sum("__sum").over(whole).alias(f"{name}_total"),
    )
    inside = Window.partitionBy(group, "__bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("__inside", F.coalesce(F.sum("__amount").over(inside), F.lit(0)))
    return (
        placed.join(offsets, [group, "__bucket"])
        .withColumn(f"{name}_before", F.col("__offset") + F.col("__inside"))
        .drop("__bucket", "__amount", "__inside", "__offset")
    )


def ranked(df: DataFrame, *order: Column) -> DataFrame:
    """Held rows in their order with `__rank`, counted from 0. Only one number per partition reaches the driver."""
    shared_folder(df.sparkSession)
    placed = df.orderBy(*order).withColumn("__place", F.monotonically_increasing_id()).checkpoint()
    part, inside = F.shiftright("__place", 33), F.col("__place").bitwiseAND((1 << 33) - 1)
    counts = placed.groupBy(part.alias("part")).count().collect()
    start, starts = 0, []
    for row in sorted(counts, key=lambda row: row["part"]):
        starts += [F.lit(row["part"]), F.lit(start)]
        start += row["count"]
    if not starts:
        return placed.withColumn("__rank", F.lit(0).cast("long")).drop("__place")
    return placed.withColumn("__rank", F.create_map(*starts)[part].cast("long") + inside).drop("__place")
