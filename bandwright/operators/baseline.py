"""Per-entity mean and deviation, the scale every reading is judged on.

A baseline is small next to the readings (one row per entity) but nothing bounds the number of entities.
So it is computed once, checkpointed to the shared folder, and its size measured in the same job. How the
readings meet it is decided from that size:

* it fits `broadcast_bytes`: broadcast; the readings are filtered where they lie and never shuffled;
* it does not: one shuffle join on entity and salt. Readings of an entity that would outgrow its share of a partition are
  spread over salts, and its row of the baseline is there once per salt (see `salted`). The readings are scanned once.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F
from pyspark.sql.types import ArrayType, BinaryType, StringType, StructType

from ..functions.checks import require_choice, require_columns, require_positive
from ..functions.missing import is_infinite, nan_to_null
from ..storage import shared_folder

BROADCAST_BYTES = 64 * 1024 * 1024
#: Readings of one entity that one task may sort for window functions.
WINDOW_READINGS = 1 << 20
PLANS = ("join", "window")
ZERO_BAND = ("constant", "reference")
ON_UNDEFINED = ("drop", "keep")

READINGS = "__readings"
MEAN = "__mean"
STDDEV = "__stddev"
LOWEST = "__lowest"
USED = "__used"
VALUE = "__value"
LOW = "__low"
HIGH = "__high"
SALT = "__salt"
SALTS = "__salts"


def band(part: str, k: float, zero_band: str = "constant", on_undefined: str = "drop") -> tuple[Column, Column]:
    """The inclusive limits of the band, from the statistics whose names begin with `part`.

    * deviation 0: all readings had one value. `mean` is a rounded sum and may miss that value by one bit, so the limits
      are the value itself. `zero_band="reference"` uses mean ± 0 instead.
    * deviation NULL (a single reading): no limits, so the reading is neither inside nor outside. `on_undefined="keep"`
      opens the band instead.
    """
    require_positive("k", k)
    require_choice("zero_band", zero_band, ZERO_BAND)
    require_choice("on_undefined", on_undefined, ON_UNDEFINED)
    mean, stddev, lowest = (F.col(f"{part}{name}") for name in (MEAN, STDDEV, LOWEST))

    def limit(side: int) -> Column:
        edge = mean + side * F.lit(float(k)) * stddev
        if zero_band == "constant":
            edge = F.when(stddev == 0, lowest).otherwise(edge)
        if on_undefined == "keep":
            edge = F.when(stddev.isNull(), F.lit(side * float("inf"))).otherwise(edge)
        return edge

    return limit(-1), limit(+1)


@dataclass(frozen=True)
class Baseline:
    """One row per entity: key, number of readings, mean, sample deviation, smallest value.

    `readings` counts all rows it was fitted on, `used` those whose value went into it.
    """

    frame: DataFrame
    key: str
    entities: int
    readings: int
    used: int
    key_bytes: int

    @property
    def row_bytes(self) -> int:
        """Upper bound for one row in a broadcast hash table: two copies of the key, ten 8-byte words and
        the table's own entry."""
        return 2 * self.key_bytes + 80 + 64

    @property
    def size_bytes(self) -> int:
        return self.entities * self.row_bytes

    def bounds(self, k: float, zero_band: str = "constant", on_undefined: str = "drop") -> DataFrame:
        """Key, mean, deviation and the limits of the band, see `band`."""
        low, high = band("", k, zero_band, on_undefined)
        return self.frame.select(self.key, READINGS, MEAN, STDDEV, low.alias(LOW), high.alias(HIGH))


@dataclass(frozen=True)
class Profile:
    """One row per entity with the statistics of several baselines, side by side under prefixed names.

    `used` says how many readings went into each of them, `counters` how many rows met each condition.
    """

    frame: DataFrame
    key: str
    entities: int
    readings: int
    key_bytes: int
    used: dict[str, int]
    counters: dict[str, int]

    def baseline(self, part: str) -> Baseline:
        statistics = (F.col(f"{part}{name}").alias(name) for name in (USED, MEAN, STDDEV, LOWEST))
        frame = self.frame.where(F.col(self.key).isNotNull()).select(self.key, READINGS, *statistics)
        return Baseline(frame, self.key, self.entities, self.readings, self.used[part], self.key_bytes)

    @property
    def sizes(self) -> dict:
        """All but the frame, to be stored beside it."""
        names = ("key", "entities", "readings", "key_bytes", "used", "counters")
        return {name: getattr(self, name) for name in names}


def _key_width(df: DataFrame, key: str) -> Column:
    """Bytes of the longest key; of a nested key, those of its text and as much again for its fields."""
    kind, width = df.schema[key].dataType, F.lit(16)
    if isinstance(kind, (StringType, BinaryType)):
        width = F.octet_length(key)
    elif isinstance(kind, (StructType, ArrayType)):
        width = 2 * F.octet_length(F.col(key).cast("string")) + 64
    return F.coalesce(F.max(width), F.lit(0))


def _measured(df: DataFrame, key: str, counters: tuple[str, ...] = ()) -> tuple[DataFrame, dict]:
    """Checkpoint an entity table and read its size, and the sums of `counters`, from the same job.

    The observation sits above the aggregation, in the job's last stage, where Spark counts every task
    once even if executors are lost and stages rerun.
    """
    shared_folder(df.sparkSession)
    seen = Observation()
    held = df.observe(
        seen,
        F.count(F.lit(1)).alias("entities"),
        _key_width(df, key).alias("key_bytes"),
        *(F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in (READINGS, *counters)),
    ).checkpoint()
    return held, seen.get


def profile(
    df: DataFrame,
    key: str,
    value: str,
    parts: Mapping[str, Column | None],
    nan_is_null: bool = True,
    counters: Mapping[str, Column] | None = None,
) -> Profile:
    """Fit one baseline per entry of `parts` (a row condition, or None for all rows) in one pass, on finite values.

    `counters` are row conditions; how many rows of `df` meet each is returned beside the baselines.

    One scan of the key, the value and the columns the conditions read; one shuffle of per-task partial
    aggregates, so an entity that holds most of the readings costs no more than any other.
    """
    require_columns(df, (key, value))
    if df.isStreaming:
        raise ValueError("a baseline cannot be fitted on a stream; pass one fitted on a batch frame")
    if len(parts) == 1 and not counters:
        # A single condition can be a filter, which reaches the scan.
        (condition,) = parts.values()
        known = F.col(key).isNotNull()
        df = df.where(known if condition is None else known & condition)
        parts = dict.fromkeys(parts)
    reading = (nan_to_null(df, value) if nan_is_null else F.col(value)).cast("double")
    # One infinite value would make the mean infinite and the band empty, so that every reading was outside it.
    reading = F.when(~is_infinite(df, value), reading)
    flags = {f"__{name}": condition for name, condition in (counters or {}).items()}

    # Conditions are evaluated once per row, below the aggregation, not once per aggregate.
    columns = [
        (reading if condition is None else F.when(condition, reading)).alias(f"{part}{VALUE}")
        for part, condition in parts.items()
    ]
    columns += [condition.alias(name) for name, condition in flags.items()]
    aggregates = [F.count(F.lit(1)).alias(READINGS), *(F.count_if(name).alias(name) for name in flags)]
    for part in parts:
        v = F.col(f"{part}{VALUE}")
        aggregates += [
            F.count(v).alias(f"{part}{USED}"),
            F.mean(v).alias(f"{part}{MEAN}"),
            F.stddev_samp(v).alias(f"{part}{STDDEV}"),
            F.min(v).alias(f"{part}{LOWEST}"),
        ]
    return _profiled(df.select(key, *columns).groupBy(key).agg(*aggregates), key, tuple(parts), tuple(flags))


def _profiled(frame: DataFrame, key: str, parts: tuple[str, ...], flags: tuple[str, ...]) -> Profile:
    held, size = _measured(frame, key, (*flags, *(f"{part}{USED}" for part in parts)))
    used = {part: size[f"{part}{USED}"] for part in parts}
    counters = {name.removeprefix("__"): size[name] for name in flags}
    return Profile(held, key, size["entities"], size[READINGS], size["key_bytes"], used, counters)


def fit_baseline(
    df: DataFrame, key: str, value: str, where: Column | None = None, nan_is_null: bool = True
) -> Baseline:
    """Mean and sample deviation of `value` per `key`, over the rows that satisfy `where`."""
    return profile(df, key, value, {"all": where}, nan_is_null).baseline("all")


_STORED = {READINGS: "readings", USED: "used", MEAN: "mean", STDDEV: "stddev", LOWEST: "lowest"}


def store_baseline(baseline: Baseline, path: str, mode: str = "error") -> None:
    """Write a baseline as a Parquet table, to judge later readings by the same scale."""
    renamed = (F.col(inner).alias(outer) for inner, outer in _STORED.items())
    baseline.frame.select(baseline.key, *renamed).write.mode(mode).parquet(path)


def load_baseline(spark: SparkSession, path: str, key: str) -> Baseline:
    """Read a stored baseline and measure its size, which decides how it will be joined."""
    stored = spark.read.parquet(path)
    require_columns(stored, (key, *_STORED.values()))
    frame = stored.select(key, *(F.col(outer).alias(inner) for inner, outer in _STORED.items()))
    size = frame.agg(
        F.count(F.lit(1)).alias("entities"),
        F.coalesce(F.sum(READINGS), F.lit(0)).alias("readings"),
        F.coalesce(F.sum(USED), F.lit(0)).alias("used"),
        _key_width(frame, key).alias("key_bytes"),
    ).first()
    return Baseline(frame, key, size.entities, size.readings, size.used, size.key_bytes)


def merge_baselines(first: Baseline, second: Baseline) -> Baseline:
    """The baseline of two sets of readings together, from theirs: to rounding, as if fitted on both at once."""
    if first.key != second.key:
        raise ValueError(f"the keys differ: {first.key!r} and {second.key!r}")
    merged = _merged(first.frame, second.frame, first.key, ("",), ())
    held, size = _measured(merged, first.key, (USED,))
    return Baseline(held, first.key, size["entities"], size[READINGS], size[USED], size["key_bytes"])


def merge_profiles(first: Profile, second: Profile) -> Profile:
    """The profile of two sets of readings together, as `merge_baselines` does it for each of their baselines."""
    if (first.key, set(first.used), set(first.counters)) != (second.key, set(second.used), set(second.counters)):
        raise ValueError("the profiles differ in key, baselines or counters")
    parts, flags = tuple(first.used), tuple(f"__{name}" for name in first.counters)
    return _profiled(_merged(first.frame, second.frame, first.key, parts, flags), first.key, parts, flags)


def _merged(left: DataFrame, right: DataFrame, key: str, parts: tuple[str, ...], flags: tuple[str, ...]) -> DataFrame:
    """Counts add up; mean and squared deviation are combined from the difference of the means, which keeps digits that
    sums of squares would lose. One join of the two entity tables; no reading is read again."""
    names = [READINGS, *flags, *(f"{part}{name}" for part in parts for name in (USED, MEAN, STDDEV, LOWEST))]
    sides = [
        # Rows without an entity count, and must meet although NULL equals nothing.
        frame.select(
            F.col(key).alias(f"{key}{side}"), *(F.col(name).alias(f"{name}{side}") for name in names)
        )
        for side, frame in ((1, left), (2, right))
    ]
    both = sides[0].join(sides[1], F.col(f"`{key}1`").eqNullSafe(F.col(f"`{key}2`")), "full")

    def number(name: str, side: int) -> Column:
        return F.coalesce(F.col(f"{name}{side}"), F.lit(0))

    columns = [F.coalesce(F.col(f"`{key}1`"), F.col(f"`{key}2`")).alias(key)]
    columns += [(number(name, 1) + number(name, 2)).alias(name) for name in (READINGS, *flags)]
    for part in parts:
        used, mean, stddev, lowest = (f"{part}{name}" for name in (USED, MEAN, STDDEV, LOWEST))
        n1, n2 = number(used, 1), number(used, 2)
        total = n1 + n2
        delta = number(mean, 2) - number(mean, 1)
        squares = sum(
            (number(stddev, i) * number(stddev, i) * (number(used, i) - 1) for i in (1, 2)), F.lit(0.0)
        )
        mixed = F.when((n1 > 0) & (n2 > 0), delta * delta * n1 * n2 / total).otherwise(0.0)
        joint = number(mean, 1) + delta * n2 / F.nullif(total, F.lit(0))
        columns += [
            total.alias(used),
            F.when(n1 == 0, F.col(f"{mean}2")).when(n2 == 0, F.col(f"{mean}1")).otherwise(joint).alias(mean),
            F.when(total > 1, F.sqrt((squares + mixed) / (total - 1))).alias(stddev),
            F.least(f"{lowest}1", f"{lowest}2").alias(lowest),
        ]
    return both.select(*columns)


def largest_entity(df: DataFrame, key: str) -> int:
    """Readings of the entity that has most; one pass over the key alone."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]


def windowed_bounds(
    df: DataFrame, key: str, reading: Column, k: float, zero_band: str = "constant", on_undefined: str = "drop"
) -> DataFrame:
    """Readings with the limits of their entity, from window functions over these very rows: one scan and one shuffle, no
    baseline in between. All readings of an entity meet in one task, so this is for entities of bounded size."""
    over = Window.partitionBy(key)
    rows = df.where(F.col(key).isNotNull()).withColumn(VALUE, reading.cast("double"))
    rows = rows.withColumns(
        {MEAN: F.mean(VALUE).over(over), STDDEV: F.stddev_samp(VALUE).over(over), LOWEST: F.min(VALUE).over(over)}
    )
    low, high = band("", k, zero_band, on_undefined)
    return rows.withColumns({LOW: low, HIGH: high}).drop(VALUE, LOWEST)


def salted(df: DataFrame, baseline: Baseline, same_rows: bool, broadcast_bytes: int) -> tuple[DataFrame, int]:
    """Entities whose readings are to be spread, with the number of their salts, and the readings one salt may hold.

    That is half of an average shuffle partition. Fewer than two entities per partition can reach it, whatever the data;
    where even so many would outgrow the broadcast budget, a salt holds more.
    """
    key, spark = baseline.key, df.sparkSession
    counts, total = baseline.frame.select(key, READINGS), baseline.readings
    if not (same_rows or df.isStreaming):
        # The baseline's counts say nothing about other rows.
        known = df.where(F.col(key).isNotNull())
        counts, size = _measured(known.groupBy(key).agg(F.count(F.lit(1)).alias(READINGS)), key)
        total = size[READINGS]
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    room = max(1, min(2 * partitions, broadcast_bytes // baseline.row_bytes))
    piece = total // room + 1
    salts = F.ceil(F.col(READINGS) / piece).cast("int")
    return counts.where(F.col(READINGS) > piece).select(key, salts.alias(SALTS)), piece


def join_bounds(
    df: DataFrame,
    baseline: Baseline,
    bounds: DataFrame,
    same_rows: bool,
    broadcast_bytes: int = BROADCAST_BYTES,
    how: str = "inner",
) -> DataFrame:
    """Join (inner or left) of readings with the limits of their entity.

    `same_rows` says that the baseline was fitted on (a superset of) these rows, so that its counts tell which entities
    are hot here; otherwise they are counted when the choice depends on it. A stream is judged by the baseline's counts.
    """
    key = baseline.key
    bounds = bounds.drop(READINGS)
    if baseline.size_bytes <= broadcast_bytes:
        return df.join(F.broadcast(bounds), key, how)
    hot, _ = salted(df, baseline, same_rows, broadcast_bytes)
    hot = F.broadcast(hot)
    every = F.xxhash64(*(name for name, kind in df.dtypes if not kind.startswith("map")))
    # Rows without an entity find nothing, so any salt will do for them.
    salt = F.when(F.col(SALTS).isNotNull(), F.pmod(every, F.col(SALTS)))
    if how == "left":
        salt = salt.when(F.col(key).isNull(), F.pmod(every, F.lit(1024)))
    else:
        df = df.where(F.col(key).isNotNull())
    readings = df.join(hot, key, "left").withColumn(SALT, salt.otherwise(0).cast("int")).drop(SALTS)
    repeated = (
        bounds.join(hot, key, "left")
        .withColumn(SALT, F.explode(F.sequence(F.lit(0), F.coalesce(SALTS, F.lit(1)) - 1)))
        .drop(SALTS)
    )
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if baseline.size_bytes <= partitions * broadcast_bytes // 4:
        # A partition's share of the entities, as measured, is a small hash table, and the readings need no sort.
        repeated = repeated.hint("shuffle_hash")
    return readings.join(repeated, [key, SALT], how).drop(SALT)
