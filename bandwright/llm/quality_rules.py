"""Quality rules: line frequency across the documents of a host, and rules on a document by itself.

Lines are normalised and hashed together with their host. A line that stands in too many different texts of one host
is boilerplate and is removed; a document that loses most of its words is rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import BROADCAST_BYTES, SPACES, attach, group_key, held, shielded, unshielded, without, words

SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_DOCUMENTS = 10
SHARE = 0.02
LOST_PERCENT = 70
RULES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _line_hashes(text: Column, host: Column) -> Column:
    """Per line a hash of the host and the line, lower case, white space single; NULL for a line without words."""
    plain = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09\x0B-\x0D]+", " ")
    return F.transform(
        F.split(plain, "\n", -1), lambda x: F.when(F.trim(x) != "", F.xxhash64(host, F.trim(x)))
    )


def _line_words(text: Column) -> Column:
    plain = F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09\x0B-\x0D]+", " ")
    return F.transform(
        F.split(plain, "\n", -1),
        lambda x: F.when(F.trim(x) != "", F.length(F.trim(x)) - F.length(without(F.trim(x), " ")) + 1).otherwise(0),
    )


def with_text_rules(df: DataFrame, text: Column) -> DataFrame:
    """Add `n_words`, `word_chars`, `n_symbols`, `n_dup_lines`, `n_repeat_words` and `base_failed`.

    Windows of five words are compared by hash; only texts in which one occurs twice sort them. What repeated windows
    cover is counted from the gaps between their sorted places.
    """
    whole = F.coalesce(text, F.lit(""))
    filled = F.filter(_lines(text), lambda x: without(x, SPACES) != "")
    step = df.select(
        "*",
        F.transform(words(text), lambda x: F.xxhash64(x)).alias("__hashes"),
        filled.alias("__filled"),
        F.length(without(whole, SPACES)).cast("long").alias("word_chars"),
        (F.length(whole) - F.length(without(whole, SYMBOLS))).cast("long").alias("n_symbols"),
    )
    h = F.col("__hashes")
    n = F.size(h)
    windows = F.transform(
        F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*(F.get(h, i + k) for k in range(WINDOW)))
    )
    step = step.select(
        "*",
        n.cast("long").alias("n_words"),
        (F.size("__filled") - F.size(F.array_distinct("__filled"))).cast("long").alias("n_dup_lines"),
        F.when(n >= WINDOW, windows).alias("__windows"),
    ).drop("__hashes", "__filled")
    w = F.col("__windows")
    repeats = F.size(F.array_distinct(w)) < F.size(w)
    sorted_windows = F.array_sort(F.transform(w, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    step = step.withColumn("__sorted", F.when(repeats, sorted_windows)).drop("__windows")
    s = F.col("__sorted")
    twice = F.filter(
        s,
        lambda x, i: (F.get(s, i - 1)["h"] == x["h"]).eqNullSafe(True) | (F.get(s, i + 1)["h"] == x["h"]).eqNullSafe(True),
    )
    step = step.withColumn("__places", F.array_sort(F.transform(twice, lambda x: x["i"]))).drop("__sorted")
    p = F.col("__places")
    covered = F.transform(p, lambda x, i: F.least(F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW)), F.lit(WINDOW)))
    total = F.aggregate(covered, F.lit(0), lambda a, x: a + x)
    step = step.withColumn("n_repeat_words", F.coalesce(total, F.lit(0)).cast("long")).drop("__places")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    step = step.withColumn("base_failed", failed)
    # A later filter on these columns must not move below the steps above: it would inline them into each other's
    # lambdas. It cannot move below a generator that makes the columns.
    return step.select(*df.columns, F.inline(F.array(F.struct(*RULES))))


def frequent_lines(
    docs: DataFrame, text: str, host: str, min_documents: int = MIN_DOCUMENTS, share: float = SHARE
) -> DataFrame:
    """Held table of texts that contain frequent lines: host and text hashes, the lines, and the words in them.

    A line is frequent if more than `min_documents` different texts of its host contain it, and more than `share` of
    all different texts of that host. Copies of a text count once; they are collapsed before lines are counted.
    Shuffles: line hashes of different texts, then partial counts per line. Nothing is sorted by host, so a host or
    a line with most of the rows is counted by every task.
    """
    inner, names = shielded(docs, text, host)
    body, g = F.col(names[text]), F.xxhash64(group_key(F.col(names[host])))
    arrays = inner.select(
        g.alias("g"),
        F.xxhash64(body).alias("a"),
        F.xxhash64(body, F.lit(1)).alias("b"),
        _line_hashes(body, g).alias("lines"),
        _line_words(body).alias("counts"),
    )
    texts = held(arrays.groupBy("g", "a", "b").agg(F.first("lines").alias("lines"), F.first("counts").alias("counts")))
    in_text = texts.select("g", F.explode(F.array_compact(F.array_distinct("lines"))).alias("line"))
    counted = in_text.groupBy("line").agg(F.first("g").alias("g"), F.count(F.lit(1)).alias("n"))
    sizes = held(texts.groupBy("g").agg(F.count(F.lit(1)).alias("size")))
    often = attach(counted.where(F.col("n") > min_documents), sizes, "g", F.col("line"))
    often = held(often.where(F.col("n") > share * F.col("size")).select("line"))
    each = texts.select(
        "g", "a", "b", F.explode(F.arrays_zip("lines", "counts")).alias("x")
    ).select("g", "a", "b", F.col("x.lines").alias("line"), F.col("x.counts").alias("words"))
    hit = attach(each.where("line IS NOT NULL"), often, "line", F.col("a"))
    return held(
        hit.groupBy("g", "a", "b").agg(F.collect_set("line").alias("lines"), F.sum("words").alias("lost"))
    )


def _judged(
    docs: DataFrame, text: str, host: str, min_documents: int, share: float, lost_percent: int
) -> tuple[DataFrame, dict[str, str]]:
    depleted = frequent_lines(docs, text, host, min_documents, share)
    inner, names = shielded(docs, text, host)
    body, g = F.col(names[text]), F.xxhash64(group_key(F.col(names[host])))
    marked = with_text_rules(inner, body).select(
        "*", g.alias("g"), F.xxhash64(body).alias("a"), F.xxhash64(body, F.lit(1)).alias("b")
    )
    size = depleted.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("lines")).alias("lines")).first()
    if size.n * 128 + 8 * (size.lines or 0) <= BROADCAST_BYTES:
        depleted = F.broadcast(depleted)
    joined = marked.join(depleted, ["g", "a", "b"], "left").withColumn("lost", F.coalesce("lost", F.lit(0)).cast("long"))
    verdict = ~F.col("base_failed") & (100 * F.col("lost") <= lost_percent * F.col("n_words"))
    return joined.withColumn("kept", verdict), names


def quality_rules(
    docs: DataFrame,
    text: str = "text",
    host: str = "source",
    min_documents: int = MIN_DOCUMENTS,
    share: float = SHARE,
    lost_percent: int = LOST_PERCENT,
) -> DataFrame:
    """All rows with the counts of `with_text_rules`, `lost` (words in frequent lines), `base_failed` and `kept`.

    * `kept` is false if the document fails by itself, or if frequent lines hold more than `lost_percent` of its words.
    * A NULL or empty text has no words and fails. A NULL host is a host of its own. Repeated rows are judged alike.
    * An input column named like an output gives way to it. No rows in, no rows out.
    """
    joined, _ = _judged(docs, text, host, min_documents, share, lost_percent)
    return unshielded(joined, docs.columns, {name: F.col(name) for name in (*RULES, "lost", "kept")})


def apply_quality_rules(
    docs: DataFrame, text: str = "text", host: str = "source", n_chars: str = "n_chars", **limits
) -> DataFrame:
    """The documents kept, with the columns they came with, their frequent lines removed, and their length put right."""
    settings = {"min_documents": MIN_DOCUMENTS, "share": SHARE, "lost_percent": LOST_PERCENT} | limits
    joined, names = _judged(docs, text, host, **settings)
    body = F.col(names[text])
    hashes = _line_hashes(body, F.col("g"))
    left = F.transform(
        F.filter(
            F.arrays_zip(_lines(body).alias("line"), hashes.alias("hash")),
            lambda x: x["hash"].isNull() | ~F.array_contains(F.col("lines"), x["hash"]),
        ),
        lambda x: x["line"],
    )
    clean = F.when(F.col("lines").isNull(), body).otherwise(F.array_join(left, "\n"))
    kept = joined.where("kept").withColumn(names[text], clean)
    if n_chars in names:
        kind = docs.schema[n_chars].dataType
        kept = kept.withColumn(names[n_chars], F.length(names[text]).cast(kind))
    return unshielded(kept, docs.columns, {})
