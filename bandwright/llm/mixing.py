"""Mix sources to target weights by weighted sampling without replacement.

Every document draws an exponential key divided by its quality weight (Efraimidis and Spirakis); within a source,
documents in the order of their keys are a weighted sample of any length. A source whose target is above its own
size is first taken whole, as often as it fits, and only the rest of the target is filled from that order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import BUCKETS, WORD, attach, group_key, ranked, running, shielded, staged, uniform, unshielded, without

SYMBOLS = "#*$%&|<>"
#: A source that ends farther from its target, as a share of it, is filled once more.
NEAR = 0.01
#: Documents of a source that are looked at in one round, once it has less room than one more document.
STRETCH = 256


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def plain_text_weight(text: Column) -> Column:
    """1 for text without `SYMBOLS`, down to 0.1 for text full of them."""
    length = F.length(text)
    symbols = length - F.length(without(text, SYMBOLS))
    weight = F.greatest(F.lit(0.1), F.lit(1.0) - F.lit(4.0) * symbols / length)
    return F.when(length > 0, weight).otherwise(F.lit(1.0))


def water_fill(sources: DataFrame, share: float, most: float) -> DataFrame:
    """Add `target` to held sources with `size` and `weight`: `share` of all sizes dealt by weight, none above
    `most` times its size; what is above goes to the others by weight, until none is above.

    Each round is one aggregate over the sources; two sums reach the driver.
    """
    cap = F.col("size") * most
    total = sources.agg(F.sum("size").alias("size"), F.sum("weight").alias("weight")).first()
    budget, level, before = share * (total["size"] or 0), None, None
    capped = F.lit(False)
    while True:
        left = sources.agg(
            F.coalesce(F.sum(F.when(capped, cap)), F.lit(0.0)).alias("caps"),
            F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0.0)).alias("weights"),
            F.coalesce(F.count_if(capped), F.lit(0)).alias("n"),
        ).first()
        if left["n"] == before or not left["weights"]:
            break
        level, before = (budget - left["caps"]) / left["weights"], left["n"]
        capped = cap <= F.lit(level) * F.col("weight")
    target = F.when(capped, cap).otherwise(F.lit(level or 0.0) * F.col("weight")) if level is not None else cap
    return sources.withColumn("target", target.cast("double"))


def _position() -> Column:
    return F.col("key") / (1 + F.col("key"))


def _bucket() -> Column:
    return F.least(F.floor(_position() * BUCKETS), F.lit(BUCKETS - 1)).cast("int")


def _order(*names: str) -> Column:
    return F.struct(*(F.col(name) for name in names or ("key", "a", "b")))


def _is(row: str) -> Column:
    """Whether this is the row a source names in a column, if it names one."""
    return F.coalesce((F.col(f"{row}.a") == F.col("a")) & (F.col(f"{row}.b") == F.col("b")), F.lit(False))


def _candidates(narrow: DataFrame, rooms: DataFrame) -> DataFrame:
    """Rows that fit the `room` of their source, without its `head`, behind the row `at` if there is one."""
    rows = attach(narrow, rooms, "g", F.col("a"))
    behind = F.col("at").isNull() | (_order() > F.col("at"))
    return rows.where((F.col("size") > 0) & (F.col("size") <= F.col("room")) & ~_is("head") & behind)


def _walked(narrow: DataFrame, rooms: DataFrame) -> DataFrame:
    """The next `STRETCH` candidates of each source, taken in key order while they fit: `room` left, the `taken` rows, and
    the last row looked at, `at`, if others follow it. Sources without candidates are left out."""
    rows = _candidates(narrow, rooms).withColumn("bucket", _bucket())
    earlier = Window.partitionBy("g").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("g", "bucket").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    cuts = counts.groupBy("g").agg(
        F.max(F.when(F.col("before") < STRETCH, F.col("bucket"))).alias("cut"), F.sum("n").alias("candidates")
    )
    cuts = staged(rooms.join(cuts, "g").select(*rooms.columns, "cut", "candidates"), "mixing-cuts")
    near = _candidates(narrow, cuts).where(_bucket() <= F.col("cut"))
    near = near.withColumn("nth", F.row_number().over(Window.partitionBy("g").orderBy("key", "a", "b")))
    near = near.where(F.col("nth") <= STRETCH).groupBy("g", "room", "candidates")
    near = near.agg(F.sort_array(F.collect_list(_order("key", "a", "b", "size"))).alias("rows"))
    none = F.filter(F.transform("rows", lambda x: F.struct(x["a"].alias("a"), x["b"].alias("b"))), lambda x: F.lit(False))

    def step(state: Column, row: Column) -> Column:
        more = F.struct(
            (state["room"] - row["size"]).alias("room"),
            F.concat(state["taken"], F.array(F.struct(row["a"].alias("a"), row["b"].alias("b")))).alias("taken"),
        )
        return F.when(row["size"] <= state["room"], more).otherwise(state)

    walk = F.aggregate("rows", F.struct(F.col("room").alias("room"), none.alias("taken")), step)
    end = F.struct(*(F.element_at("rows", -1)[name].alias(name) for name in ("key", "a", "b")))
    near = near.withColumn("walk", walk).withColumn("at", F.when(F.size("rows") < F.col("candidates"), end))
    return near.select("g", "walk.room", "walk.taken", "at")


def _filled(narrow: DataFrame, rooms: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Fill the `room` of each source, in which its `head`, if any, has its place already.

    By source: `head`; `stop`, the first row by key that does not fit any more (what fits before it is taken); `last`, the
    row that comes at the end; how far the source ends from its room, `missed`. And the rows `g`, `a`, `b` that are taken
    behind `stop`, of which there are few: a source's room is smaller than one document by then.
    """
    rooms = rooms.select("g", "room", "head", F.lit(None).cast("struct<key: double, a: long, b: long>").alias("at"))
    first = running(_candidates(narrow, rooms), "g", _position(), [F.col("key"), F.col("a"), F.col("b")], F.col("size"), "size")
    over = F.col("size_before") + F.col("size") > F.col("room")
    ends = first.groupBy("g").agg(
        F.min(F.when(over, _order("key", "a", "b", "size"))).alias("stop"),
        F.sum(F.when(~over, F.col("size"))).alias("used"),
    )
    left = (F.col("room") - F.coalesce("used", F.lit(0))).alias("left")
    ends = staged(rooms.join(ends, "g", "left").select("g", "room", "head", "stop", left), "mixing-ends")
    stop = F.struct("stop.key", "stop.a", "stop.b")
    ahead = ends.where("stop IS NOT NULL").select("g", F.col("left").alias("room"), "head", stop.alias("at"))
    taken, shrunk = ends.limit(0).select("g", F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b")), ends.select("g", "left")
    while not ahead.isEmpty():
        walked = staged(_walked(narrow, ahead), "mixing-walked")
        taken = taken.unionByName(walked.select("g", F.explode("taken").alias("row")).select("g", "row.a", "row.b"))
        shrunk = shrunk.unionByName(walked.select("g", F.col("room").alias("left")))
        ahead = walked.where("at IS NOT NULL").join(ends.select("g", "head"), "g").select("g", "room", "head", "at")
    shrunk = shrunk.groupBy("g").agg(F.min("left").alias("left"))  # room only shrinks
    ends = staged(ends.drop("left").join(shrunk, "g"), "mixing-filled")
    gap = F.abs(F.col("size") - F.col("left"))
    last = _chosen(narrow, ends, taken).where(~F.col("chosen") & (F.col("size") > 0) & (gap < F.col("left"))).groupBy("g")
    last = last.agg(F.min(F.struct(gap.alias("gap"), "key", "a", "b")).alias("last"))
    missed = F.coalesce("last.gap", "left").alias("missed")
    return staged(ends.join(last, "g", "left").select("g", "room", "head", "stop", "last", missed), "mixing-last"), taken


def _chosen(narrow: DataFrame, ends: DataFrame, taken: DataFrame) -> DataFrame:
    """Every row with what its source's row in `ends` has, and whether it is `chosen`, not counting the last one."""
    rows = attach(narrow, ends, "g", F.col("a"))
    rows = rows.join(taken.withColumn("walked", F.lit(True)), ["g", "a", "b"], "left")
    before = F.col("stop").isNull() | (_order("key", "a", "b") < F.struct("stop.key", "stop.a", "stop.b"))
    first = (F.col("size") > 0) & (F.col("size") <= F.col("room")) & before
    return rows.withColumn("chosen", first | _is("head") | F.coalesce("walked", F.lit(False))).drop("walked")


def mix(
    docs: DataFrame,
    text: str = "text",
    source: str = "source",
    doc_id: str = "doc_id",
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    quality: Column | None = None,
    seed: int = 42,
) -> DataFrame:
    """All documents with `size`, `source_size`, `target`, `copies` and `taken`.

    * `size` is the number of words, 0 for a NULL or empty text; such documents are never taken.
    * Sources in code point order, NULL last, have the `weights`, repeated. Targets: see `water_fill`.
    * A source's target is met by whole epochs (`floor(target / size)` copies of everything), then by documents in
      key order while they fit. What is still missing is filled from those left that are short enough, again in key
      order, until nothing left fits; then comes the one document, if any, with which the source ends nearest. It then
      misses its target by up to half of the smallest document left.
    * Where that is over `NEAR` of the target, which takes a source of few documents, the source is filled once more
      with the first document that did not fit at its head, and the nearer of the two stays.
    * `quality` (default: `plain_text_weight`) is above 0; documents of higher quality come earlier.
    * Keys depend on `doc_id`, text and `seed` only: runs agree, whatever the partitioning, and rows of one id (or none)
      are spread like others. Rows that are equal in id, source and text are taken together or not at all.
    * No rows in, no rows out. An input column named like an output gives way to it.

    One scan counts words; all else until the final join handles narrow rows. A source with most of the rows is cut
    by key into buckets, see `running`.
    """
    inner, names = shielded(docs, text, source, doc_id)
    body, origin, key = F.col(names[text]), F.col(names[source]), F.col(names[doc_id])
    if quality is None:
        worth = plain_text_weight(body)
    else:
        for_quality = docs.select("*", quality.alias("__quality"))
        inner = for_quality.toDF(*inner.columns, "__quality")
        worth = F.col("__quality")
    marks = [
        group_key(origin).alias("g"),
        F.xxhash64(group_key(key), body).alias("a"),
        F.xxhash64(body, group_key(key), F.lit(1)).alias("b"),
    ]
    named = F.concat_ws(":", F.coalesce(key.cast("string"), F.lit("null")), F.md5(F.coalesce(body, F.lit("")).cast("binary")))
    units = staged(
        inner.select(*marks, word_count(body).alias("words"), worth.alias("w"), uniform(named, seed).alias("u"))
        .groupBy("g", "a", "b")
        .agg(F.sum("words").alias("size"), F.max("w").alias("w"), F.max("u").alias("u"), F.count(F.lit(1)).alias("n"))
        .withColumn("key", -F.ln("u") / F.col("w")),
        "mixing-units",
    )
    found = ranked(units.groupBy("g").agg(F.sum("size").alias("size")), F.col("g"))
    weight = F.array(*(F.lit(float(w)) for w in weights))[F.col("__rank") % len(weights)]
    sources = water_fill(found.withColumn("weight", weight), share, most)
    epochs = F.when(F.col("size") > 0, F.floor(F.col("target") / F.col("size"))).otherwise(0).cast("long")
    sources = staged(
        sources.select("g", F.col("size").alias("source_size"), "target", epochs.alias("epochs")).withColumn(
            "room", F.col("target") - F.col("epochs") * F.col("source_size")
        ),
        "mixing-sources",
    )
    narrow = units.select("g", "a", "b", "size", "n", "key")
    nothing = F.lit(None).cast("struct<key: double, a: long, b: long, size: long>").alias("head")
    ends, taken = _filled(narrow, sources.select("g", "room", nothing))
    far = sources.join(ends.select("g", "missed", "stop"), "g").where(F.col("missed") > NEAR * F.col("target"))
    far = staged(far.where("stop IS NOT NULL").select("g", "room", "missed", "stop"), "mixing-far")
    if not far.isEmpty():
        again, taken_again = _filled(
            narrow, far.select("g", (F.col("room") - F.col("stop.size")).alias("room"), F.col("stop").alias("head"))
        )
        better = again.select("g", F.col("missed").alias("now")).join(far, "g").where("now < missed")
        better = staged(better.select("g"), "mixing-better")
        ends = ends.join(better, "g", "left_anti").unionByName(again.join(better, "g", "left_semi"))
        ends = staged(ends, "mixing-ends")
        taken = taken.join(better, "g", "left_anti").unionByName(taken_again.join(better, "g", "left_semi"))
    facts = ends.join(sources.select("g", "source_size", "target", "epochs"), "g")
    decided = _chosen(narrow, staged(facts, "mixing-facts"), taken)
    decided = decided.withColumns({"chosen": F.col("chosen") | _is("last"), "size": F.expr("size div n")})
    copies = F.when(F.col("size") > 0, F.col("epochs") + F.col("chosen").cast("long")).otherwise(0).cast("long")
    decided = staged(
        decided.select("g", "a", "b", "size", "source_size", "target", copies.alias("copies")), "mixing-decided"
    )

    marked = inner.select("*", *marks)
    joined = marked.join(decided, ["g", "a", "b"])
    outputs = {
        "size": F.col("size"),
        "source_size": F.col("source_size"),
        "target": F.col("target"),
        "copies": F.col("copies"),
        "taken": F.col("copies") * F.col("size"),
    }
    return unshielded(joined, docs.columns, outputs)


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every taken document as often as it is taken, with the columns of `docs`."""
    inner, _ = shielded(docs)
    names = {"text": "text", "source": "source", "doc_id": "doc_id"} | {
        k: options.pop(k) for k in ("text", "source", "doc_id") if k in options
    }
    placed = {role: f"c{docs.columns.index(name)}" for role, name in names.items()}
    chosen = mix(inner, **placed, **options)
    repeated = chosen.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return repeated.select(*(F.col(f"c{i}").alias(name) for i, name in enumerate(docs.columns)))
