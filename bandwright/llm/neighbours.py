"""Give each row something of the row that follows it in a total order, without a window over all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Ranges of the order that are sorted one by one; at most so many rows (their heads) reach the driver.
RANGES = 65_536
ROWS_PER_RANGE = 512
_COARSE = 64


def _range_of(rows: DataFrame, n: int) -> Column:
    """Number of the range a row lies in, growing with `id` and, where rows have the id of a cut, with `tie`; rows without
    id have negative numbers, by `tie`. An id that many rows share is a cut, and gets ranges by its share of the cuts."""
    drawn = rows.stat.approxQuantile("id", [i / _COARSE for i in range(_COARSE + 1)], 0.002) if n else []
    cuts, whole = sorted(set(drawn)), max(1, min(RANGES, -(-n // ROWS_PER_RANGE)))

    def by_tie(ranges: Column) -> Column:
        return F.least(F.floor((F.col("tie") / 2.0**64 + 0.5) * ranges), ranges - 1).cast("long")

    without = by_tie(F.lit(whole)) - whole
    if not cuts:
        return without
    # Each cut has ranges for rows with that very id, then ranges for those up to the next cut.
    between = max(1, whole // len(cuts))
    own = [max(1, drawn.count(cut) * whole // len(drawn)) for cut in cuts]
    starts = [sum(own[:j]) + j * between for j in range(len(cuts))]
    key = F.col("id").cast("double")

    def of_piece(piece: Column) -> Column:
        def at(values: list) -> Column:
            return F.get(F.array(*(F.lit(value) for value in values)), piece)

        low, high = at(cuts), at([*cuts[1:], cuts[-1] + 1])
        share = F.greatest(F.least(F.floor((key - low) / (high - low) * between), F.lit(between - 1)), F.lit(0))
        return at(starts) + F.when(key == low, by_tie(at(own))).otherwise(at(own) + share)

    # The piece is a lambda's argument, so it is found once and the cuts stay one literal: written out as a sum at each of
    # its places, its code passes the 64 KB of a Java method, and the driver's heap fills with what the compiler makes of it.
    later = F.array(*(F.lit(cut) for cut in cuts[1:])).cast("array<double>")
    piece = F.size(F.filter(later, lambda cut: key >= cut))
    placed = F.get(F.transform(F.array(piece), of_piece), F.lit(0))
    return F.when(F.col("id").isNotNull(), placed).otherwise(without).cast("long")


def with_next(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """Add `next_{name}` for each name: its value in the row that follows in descending `id`, then `tie`; the last row
    is followed by the first.

    `rows` must have `id` (a number) and `tie` (a long hash, spread over all longs). Rows without id come last. Rows are dealt by ranges of the
    order in one shuffle; the first row of each range is also dealt to the range before, so no range needs another.
    """
    spark = rows.sparkSession
    n = rows.select("id").count()
    placed = rows.withColumn("range", _range_of(rows.select("id", "tie"), n))
    heads = placed.groupBy("range").agg(F.max(F.struct("id", "tie")).alias("head")).collect()
    heads = sorted(heads, key=lambda row: row["range"], reverse=True)
    guests = [
        (row["range"], row["head"]["id"], row["head"]["tie"], heads[i - 1]["range"]) for i, row in enumerate(heads)
    ]
    kind = rows.schema["id"].dataType.simpleString()
    where = F.broadcast(spark.createDataFrame(guests, f"range long, head_id {kind}, head_tie long, before long"))
    is_head = F.col("id").eqNullSafe(F.col("head_id")) & (F.col("tie") == F.col("head_tie"))
    own = F.struct(F.col("range").alias("at"), F.lit(False).alias("guest"))
    other = F.struct(F.col("before").alias("at"), F.lit(True).alias("guest"))
    dealt = placed.join(where, "range").withColumn(
        "to", F.explode(F.when(is_head, F.array(own, other)).otherwise(F.array(own)))
    )
    dealt = dealt.select(*rows.columns, F.col("to.at").alias("at"), F.col("to.guest").alias("guest"))
    order = Window.partitionBy("at").orderBy("guest", F.col("id").desc_nulls_last(), F.col("tie").desc())
    following = {f"next_{name}": F.lead(name).over(order) for name in names}
    return dealt.withColumns(following).where(~F.col("guest")).drop("at", "guest")
