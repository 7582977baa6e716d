"""Secrets: assignments, access keys and long hexadecimal strings by pattern, other random strings by likelihood.

Two first-order Markov models of characters, one of random strings and one of ordinary words, are counted over the
whole corpus. A token is random if its log-likelihood ratio says so. Patterns label the samples: what they find is
random, as are digests made for the purpose; other long words are ordinary.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .common import shielded, unshielded

# The base patterns and their least lengths, in the order of kinds.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "random")
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 8, 16, 32

TOKEN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
ORDINARY = r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{12,}"
#: Mean log-likelihood ratio per pair of characters from which a token counts as random.
THRESHOLD = 0.7
CODES = 128
#: Weight of a character's own frequency beside that after its predecessor; and the most that one pair can say.
BACKOFF, CLIP = 4.0, 3.0
SPAN = "array<struct<start:int,end:int,value:string>>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is worked out once, however often it is used, in lambdas too."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _running(items: Column, value: Callable[[Column], Column], join: Callable[[Column, Column], Column], zero: Column) -> Column:
    """For each item of an array, `value` of all up to it joined (sums, or the largest so far).

    An aggregate that appends copies what it has, so one over n items would copy n * n. Here the array is cut into as many
    blocks as a block has items, each block is run through by itself, and then the blocks' ends are: n * sqrt(n).
    """

    def through(array: Column, of: Callable[[Column], Column]) -> Column:
        """What precedes each item, and last what all give."""
        return F.aggregate(
            array, F.array(zero), lambda done, x: F.concat(done, F.array(join(F.element_at(done, -1), of(x))))
        )

    def in_blocks(array: Column) -> Column:
        width = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(array)))).cast("int")
        starts = F.when(F.size(array) > 0, F.sequence(F.lit(0), F.size(array) - 1, width))
        starts = F.coalesce(starts, F.array().cast("array<int>"))
        return _let(width, lambda n: F.transform(starts, lambda at: through(F.slice(array, at + 1, n), value)))

    def joined(blocks: Column) -> Column:
        return F.flatten(
            F.zip_with(
                blocks,
                through(blocks, lambda block: F.element_at(block, -1)),
                lambda block, first: F.transform(
                    F.slice(F.coalesce(block, F.array(zero)), 2, F.size(F.coalesce(block, F.array(zero))) - 1),
                    lambda x: join(first, x),
                ),
            )
        )

    return _let(items, lambda array: _let(in_blocks(array), joined))


def _matches(text: Column, pattern: str, group: int = 0) -> Column:
    """Start, end and a group of every match, in code points.

    What lies between the matches is split off by the same pattern; lengths of both, added up, give the places.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    pieces = F.arrays_zip(found.alias("m"), F.split(text, pattern, -1).alias("gap"), values.alias("v"))

    def placed(pieces: Column) -> Column:
        ends = _running(pieces, lambda x: F.length(x["gap"]) + F.length(x["m"]), lambda a, b: a + b, F.lit(0))
        return F.zip_with(
            pieces,
            ends,
            lambda x, end: F.struct((end - F.length(x["m"])).alias("start"), end.alias("end"), x["v"].alias("value")),
        )

    places = _let(F.filter(pieces, lambda x: x["m"].isNotNull()), placed)
    return F.when(F.regexp_like(text, F.lit(pattern)), places).otherwise(F.array().cast(SPAN))


def _apart(spans: Column, others: Column) -> Column:
    """The spans (by start, not overlapping) that none of the others overlaps: all are sorted by start, and each span
    is compared with the furthest end before it and the nearest start after it."""

    def tagged(part: Column, other: bool) -> Column:
        return F.transform(
            part, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), F.lit(other).alias("other"), x["value"].alias("value"))
        )

    def kept(every: Column) -> Column:
        most = F.lit(2**31 - 1)
        ended = _running(every, lambda x: F.when(x["other"], x["end"]).otherwise(0), F.greatest, F.lit(0))
        following = _running(F.reverse(every), lambda x: F.when(x["other"], x["start"]).otherwise(most), F.least, most)
        marked = F.arrays_zip(every.alias("x"), ended.alias("ended"), F.reverse(following).alias("next"))
        alone = F.filter(
            marked, lambda m: ~m["x"]["other"] & (m["ended"] <= m["x"]["start"]) & (m["next"] >= m["x"]["end"])
        )
        return F.transform(
            alone, lambda m: F.struct(m["x"]["start"].alias("start"), m["x"]["end"].alias("end"), m["x"]["value"].alias("value"))
        )

    every = F.array_sort(F.concat(tagged(spans, False), tagged(others, True)))
    return F.when((F.size(spans) > 0) & (F.size(others) > 0), _let(every, kept)).otherwise(spans)


def _with_base(df: DataFrame, text: str) -> DataFrame:
    """Add `assign`, `access` and `hex`: the spans of the base patterns."""
    body, lowered = F.col(text), F.lower(text)
    # Substring search is much cheaper than the pattern and lets no match slip.
    named = F.lit(False)
    for word in ("passw", "secret", "token", "api"):
        named = named | lowered.contains(word)
    none = F.array().cast(SPAN)
    df = df.withColumns(
        {
            "assign": F.when(named, _matches(body, ASSIGN, 2)).otherwise(none),
            "access": F.when(body.contains("AKIA"), _matches(body, ACCESS)).otherwise(none),
            # A maximal run of at least the length is what the base pattern matches and its length lets stand.
            "hex": _matches(body, rf"(?<![0-9a-f])[0-9a-f]{{{LEAST_HEX},}}"),
        }
    )
    return df.withColumns(
        {
            "assign": F.filter("assign", lambda x: F.length(x["value"]) >= LEAST_VALUE),
            "access": F.filter("access", lambda x: F.length(x["value"]) >= LEAST_ACCESS),
        }
    )


def _pair(token: Column, i: Column) -> Column:
    return F.ascii(F.substring(token, i, 1)) * CODES + F.ascii(F.substring(token, i + 1, 1))


@dataclass(frozen=True)
class MarkovModels:
    """Log-likelihood ratio of random to ordinary for each pair of characters, `CODES` squared numbers."""

    ratios: tuple[float, ...]

    def score(self, token: Column) -> Column:
        """Mean ratio per pair; above 0 where the token is likelier to be random."""
        table = F.from_json(F.lit(json.dumps(self.ratios)), "array<double>")
        codes = F.transform(F.split(token, ""), lambda c: F.ascii(c))
        pairs = F.zip_with(
            F.slice(codes, 1, F.size(codes) - 1), F.slice(codes, 2, F.size(codes) - 1), lambda a, b: a * CODES + b
        )
        total = F.aggregate(pairs, F.lit(0.0), lambda sum_, pair: sum_ + F.get(table, pair))
        return F.when(F.length(token) > 1, total / (F.length(token) - 1)).otherwise(F.lit(0.0))


def count_pairs(samples: DataFrame) -> DataFrame:
    """Occurrences of each pair of characters by label, from rows of `label` and `token`. At most 2 * CODES ** 2 rows."""
    at = samples.where(F.length("token") > 1).select(
        "label", "token", F.explode(F.sequence(F.lit(1), F.length("token") - 1)).alias("i")
    )
    return at.groupBy("label", _pair(F.col("token"), F.col("i")).alias("pair")).agg(F.count(F.lit(1)).alias("n"))


def fit_models(samples: DataFrame) -> MarkovModels:
    """Two models from rows of `label` (1 random, 0 ordinary) and `token` (ASCII), backed off to single characters.

    All samples count; what reaches the driver is bounded by the alphabet.
    """
    counts = {(row["label"], row["pair"]): row["n"] for row in count_pairs(samples).collect()}
    used = sorted({code for _, pair in counts for code in divmod(pair, CODES)})
    first: dict[tuple[int, int], int] = {}
    second: dict[tuple[int, int], int] = {}
    for (label, pair), n in counts.items():
        a, b = divmod(pair, CODES)
        first[label, a] = first.get((label, a), 0) + n
        second[label, b] = second.get((label, b), 0) + n
    whole = [sum(n for (label, _), n in first.items() if label == k) for k in (0, 1)]

    def chance(label: int, a: int, b: int) -> float:
        alone = (second.get((label, b), 0) + 0.5) / (whole[label] + 0.5 * len(used))
        return (counts.get((label, a * CODES + b), 0) + BACKOFF * alone) / (first.get((label, a), 0) + BACKOFF)

    ratios = [0.0] * (CODES * CODES)
    for a in used:
        for b in used:
            ratio = math.log(chance(1, a, b) / chance(0, a, b))
            ratios[a * CODES + b] = round(max(-CLIP, min(CLIP, ratio)), 6)
    return MarkovModels(tuple(ratios))


def labelled_samples(docs: DataFrame, text: str = "text") -> DataFrame:
    """Rows of `label` and `token` from all documents: what the base patterns find, and two digests of each text in
    other alphabets, are random; its other words of at least 12 characters, each once a text, are ordinary."""
    inner, names = shielded(docs, text)
    based = _with_base(inner.select(F.coalesce(names[text], F.lit("")).alias("text")), "text")
    values = F.transform(F.concat("assign", "access", "hex"), lambda x: x["value"])
    digest = F.unhex(F.sha2(F.col("text"), 256))
    made = F.array(F.base64(digest), F.translate(F.base64(digest), "+/=", ""))
    based = based.select(values.alias("values"), made.alias("made"), F.regexp_extract_all(F.col("text"), F.lit(ORDINARY), F.lit(0)).alias("long"))
    values, made = F.col("values"), F.col("made")
    # No word has a space, so what stands in any of the values stands in all of them together.
    together = F.concat_ws(" ", values)
    ordinary = F.filter(F.array_distinct("long"), lambda x: ~F.contains(together, x))
    return based.select(
        F.explode(
            F.concat(
                F.transform(F.concat(values, made), lambda x: F.struct(F.lit(1).alias("label"), x.alias("token"))),
                F.transform(ordinary, lambda x: F.struct(F.lit(0).alias("label"), x.alias("token"))),
            )
        ).alias("sample")
    ).select("sample.label", "sample.token")


def find_secrets(
    docs: DataFrame, text: str = "text", models: MarkovModels | None = None, threshold: float = THRESHOLD
) -> DataFrame:
    """All rows with `secrets`: kind, start and end of each, by start, then kind; code points, ends exclusive.

    * Kinds `assign`, `access`, `hex`: the base patterns. `random`: another token of at least 20 characters, with a
      letter and a digit, that the models (default: fitted on `docs`) find random and that overlaps no base span.
    * Whole texts. NULL and empty texts have none. No shuffle; an input column named `secrets` gives way.
    """
    if models is None:
        models = fit_models(labelled_samples(docs, text))
    inner, names = shielded(docs, text)
    found = _with_base(inner.withColumn("text", F.coalesce(names[text], F.lit(""))), "text")
    likely = F.filter(
        F.regexp_extract_all(F.col("text"), F.lit(TOKEN), F.lit(0)),
        lambda x: x.rlike("[0-9]") & x.rlike("[A-Za-z]") & (models.score(x) >= threshold),
    )
    found = found.withColumn("likely", likely)
    placed = F.filter(_matches(F.col("text"), TOKEN), lambda x: F.array_contains(F.col("likely"), x["value"]))
    found = found.withColumn("random", F.when(F.size("likely") > 0, placed).otherwise(F.array().cast(SPAN)))
    found = found.withColumn("random", _apart(F.col("random"), F.concat("assign", "access", "hex")))

    def named(kind: str) -> Column:
        order = KINDS.index(kind)
        return F.transform(
            kind,
            lambda x: F.struct(
                x["start"].alias("start"), F.lit(order).alias("order"), F.lit(kind).alias("kind"), x["end"].alias("end")
            ),
        )

    every = F.array_sort(F.concat(*(named(kind) for kind in KINDS)))
    spans = F.transform(every, lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end")))
    return unshielded(found, docs.columns, {"secrets": spans})
