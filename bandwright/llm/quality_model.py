"""A quality classifier: a generalised additive model with pairwise interactions.

Every feature is cut into bins. Boosting goes round the features, and in each turn fits one shallow tree to what is
still unexplained, in that feature alone; the trees of a feature add up to a lookup table over its bins. Then the same
with the pairs of features that explain most of the rest. A score is the sum of one table entry per feature and pair.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import SPACES, arrow_function, held, shielded, without, words

#: At most so many labelled documents are fitted, those with the smallest hashes of their ids. Their features alone,
#: about 150 bytes each, reach the driver.
MOST_SAMPLES = 50_000
BINS, PAIR_BINS, PAIRS = 32, 8, 6
ROUNDS, PAIR_ROUNDS, RATE = 150, 60, 0.1
LEAST_LEAF, PENALTY = 8.0, 1.0
THRESHOLD = 0.7

FEATURES = (
    "log_words word_length symbols capitals digits marks bars lines repeated_lines different_words longest_word "
    "other_letters stops long_words short_words"
).split()


def features(df: DataFrame, text: Column) -> DataFrame:
    """Add `features`, one number per entry of `FEATURES`, all 0 for NULL or empty text. Whole texts, built-ins only."""
    body = F.coalesce(text, F.lit(""))
    step = df.select("*", body.alias("__body"), words(text).alias("__words"))
    step = step.withColumn("__lengths", F.transform("__words", lambda x: F.length(x)))
    step = step.withColumn("__lines", F.filter(F.split("__body", "\n", -1), lambda x: without(x, SPACES) != ""))
    body, w, lengths, lines = F.col("__body"), F.col("__words"), F.col("__lengths"), F.col("__lines")
    n, length = F.size(w), F.length(body)

    def share(characters: str) -> Column:
        return (length - F.length(without(body, characters))) / F.greatest(length, F.lit(1))

    def part(count: Column, of: Column) -> Column:
        return count / F.greatest(of, F.lit(1))

    chosen = {
        "log_words": F.log1p(n),
        "word_length": part(F.aggregate(lengths, F.lit(0), lambda a, x: a + x), n),
        "symbols": share("#*$%&|<>@^~\\"),
        "capitals": share("ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        "digits": share("0123456789"),
        "marks": share("!?"),
        "bars": share("|"),
        "lines": part(F.size(lines), n),
        "repeated_lines": part(F.size(lines) - F.size(F.array_distinct(lines)), F.size(lines)),
        "different_words": part(F.size(F.array_distinct(w)), n),
        "longest_word": F.log1p(F.coalesce(F.array_max(lengths), F.lit(0))),
        "other_letters": part(F.octet_length(body) - length, length),
        "stops": share(".,;:"),
        "long_words": part(F.size(F.filter(lengths, lambda x: x > 12)), n),
        "short_words": part(F.size(F.filter(lengths, lambda x: x <= 2)), n),
    }
    numbers = F.array(*(chosen[name].cast("double") for name in FEATURES))
    return step.select(*df.columns, numbers.alias("features"))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-x))


def _leaf(gradient: np.ndarray, hessian: np.ndarray) -> np.ndarray:
    return gradient / (hessian + PENALTY)


def _gain(gradient: np.ndarray, hessian: np.ndarray) -> np.ndarray:
    return gradient * gradient / (hessian + PENALTY)


def _best_cut(g: np.ndarray, h: np.ndarray, n: np.ndarray, low: int, high: int) -> tuple[float, int] | None:
    """Of the bins from `low` to before `high`, the cut that explains most, if both sides have enough samples."""
    left = [np.cumsum(x[low:high])[:-1] for x in (g, h, n)]
    whole = [x[low:high].sum() for x in (g, h, n)]
    right = [w - x for w, x in zip(whole, left)]
    gains = _gain(left[0], left[1]) + _gain(right[0], right[1]) - _gain(whole[0], whole[1])
    gains = np.where((left[2] >= LEAST_LEAF) & (right[2] >= LEAST_LEAF), gains, -1.0)
    if not len(gains) or gains.max() <= 1e-9:
        return None
    at = int(gains.argmax())
    return float(gains[at]), low + at + 1


def _shallow_tree(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """A tree of at most three cuts over the bins of one feature, as a value per bin."""
    edges = [0, len(g)]
    for _ in range(3):
        cuts = [c for low, high in zip(edges, edges[1:]) if (c := _best_cut(g, h, n, low, high))]
        if not cuts:
            break
        edges = sorted([*edges, max(cuts)[1]])
    out = np.zeros(len(g))
    if len(edges) > 2:
        for low, high in zip(edges, edges[1:]):
            out[low:high] = _leaf(g[low:high].sum(), h[low:high].sum())
    return out


def _crossed(table: np.ndarray) -> np.ndarray:
    """Sums over each bin pair's upper-left rectangle."""
    return table.cumsum(0).cumsum(1)


def _pair_tree(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[float, np.ndarray]:
    """The best cut of both features of a pair into four leaves: what it explains, and its value per bin pair."""
    sums = [_crossed(x) for x in (g, h, n)]
    quarters = []
    for s in sums:
        a, row, column, whole = s[:-1, :-1], s[:-1, -1:], s[-1:, :-1], s[-1, -1]
        quarters.append((a, row - a, column - a, whole - row - column + a))
    gains = sum(_gain(x, y) for x, y in zip(quarters[0], quarters[1])) - _gain(sums[0][-1, -1], sums[1][-1, -1])
    i, j = np.unravel_index(int(gains.argmax()), gains.shape)
    out = np.zeros_like(g)
    parts = ((slice(0, i + 1), slice(0, j + 1)), (slice(0, i + 1), slice(j + 1, None)))
    parts += ((slice(i + 1, None), slice(0, j + 1)), (slice(i + 1, None), slice(j + 1, None)))
    for quarter, (rows, columns) in enumerate(parts):
        if quarters[2][quarter][i, j] >= LEAST_LEAF:
            out[rows, columns] = _leaf(quarters[0][quarter][i, j], quarters[1][quarter][i, j])
    return float(gains[i, j]), out


@dataclass
class AdditiveModel:
    """Bin edges and a table per feature; coarse edges and a table per pair of features."""

    prior: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row: table entries of its bins, added."""
        total = np.full(len(x), self.prior)
        for j, table in enumerate(self.tables):
            total += table[np.searchsorted(self.edges[j], x[:, j], "right")]
        for (i, j), table in self.pairs.items():
            rows = np.searchsorted(self.coarse[i], x[:, i], "right")
            total += table[rows, np.searchsorted(self.coarse[j], x[:, j], "right")]
        return _sigmoid(total)


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    cuts = np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1])) if len(values) else np.zeros(0)
    return cuts[cuts > values.min()] if len(values) else cuts


def fit(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    """Boost cyclically over features, then over the pairs that gain most. Without both labels, the prior alone."""
    positive = (y.sum() + 0.5) / (len(y) + 1.0)
    model = AdditiveModel(prior=float(np.log(positive / (1 - positive))))
    if not 0 < y.sum() < len(y):
        return model
    model.edges = [_edges(x[:, j], BINS) for j in range(x.shape[1])]
    model.coarse = [_edges(x[:, j], PAIR_BINS) for j in range(x.shape[1])]
    binned = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(model.edges)]
    counts = [np.bincount(b, minlength=len(e) + 1).astype(float) for b, e in zip(binned, model.edges)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    total = np.full(len(y), model.prior)
    for _ in range(ROUNDS):
        for j, b in enumerate(binned):
            p = _sigmoid(total)
            size = len(model.tables[j])
            g, h = (np.bincount(b, weights=v, minlength=size) for v in (y - p, p * (1 - p)))
            tree = RATE * _shallow_tree(g, h, counts[j])
            model.tables[j] += tree
            total += tree[b]

    rough = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(model.coarse)]
    sizes = [len(e) + 1 for e in model.coarse]

    def sums(i: int, j: int, *values: np.ndarray) -> list[np.ndarray]:
        flat = rough[i] * sizes[j] + rough[j]
        return [np.bincount(flat, v, sizes[i] * sizes[j]).reshape(sizes[i], sizes[j]) for v in values]

    ones, p = np.ones(len(y)), _sigmoid(total)
    usable = [j for j in range(x.shape[1]) if sizes[j] > 1]
    gains = {(i, j): _pair_tree(*sums(i, j, y - p, p * (1 - p), ones))[0] for i, j in combinations(usable, 2)}
    model.pairs = {k: np.zeros((sizes[k[0]], sizes[k[1]])) for k in sorted(gains, key=gains.get, reverse=True)[:PAIRS]}
    for _ in range(PAIR_ROUNDS):
        for (i, j), table in model.pairs.items():
            p = _sigmoid(total)
            tree = RATE * _pair_tree(*sums(i, j, y - p, p * (1 - p), ones))[1]
            table += tree
            total += tree[rough[i], rough[j]]
    return model


def fit_labelled(rows: DataFrame, label: str = "label", key: str = "key", most: int = MOST_SAMPLES) -> AdditiveModel:
    """Fit rows of `features`, a 0/1 `label` and a `key`; above `most` rows, those with the smallest hashes of the key."""
    usable = rows.where(F.col(label).isin(0, 1) & F.col("features").isNotNull())
    sample = usable.select(F.xxhash64(key).alias("h"), "features", F.col(label).cast("int").alias("y"))
    taken = sample.orderBy("h", "features", "y").limit(most).select("features", "y").toArrow()
    y = taken.column("y").to_numpy().astype(float)
    flat = taken.column("features").combine_chunks()
    x = np.asarray(flat.values if isinstance(flat, pa.ListArray) else pa.concat_arrays(flat.chunks).values)
    return fit(x.reshape(len(y), len(FEATURES)), y)


def scores(model: AdditiveModel, numbers: Column) -> Column:
    """The model's score of each array of features; every Arrow batch is one matrix."""

    def of(batch: pa.Array) -> pa.Array:
        x = batch.flatten().to_numpy(zero_copy_only=False).reshape(len(batch), len(FEATURES))
        return pa.array(model.score(x))

    return arrow_function(of, "double")(numbers)


def held_out(key: Column) -> Column:
    """The rows no label is learned from: one in four, by checksum of the key."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    label: str = "quality",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per document: `doc_id`, `held_out`, `score` (0 to 1, higher: label 1 likelier) and `predicted`.

    * Only the text makes a score. Labels of held-out documents are never read; NULL or other labels than 0 and 1, and
      labels of no document, play no part; several labels of a document count each.
    * NULL and empty texts have all features 0 and a score like any other. Without labels, or with one label only, all
      scores are the smoothed share of label 1.
    * Texts are read once; features are kept and joined with the labels, which shuffles no text.
    """
    inner, names = shielded(docs, text, doc_id)
    marked = features(inner, F.col(names[text]))
    table = held(marked.select(F.col(names[doc_id]).alias("key"), "features"))
    known = labels.select(F.col(f"`{doc_id}`").alias("key"), F.col(f"`{label}`").alias("label"))
    learned = table.where(~held_out(F.col("key"))).join(known.where("label IS NOT NULL"), "key")
    model = fit_labelled(learned)
    score = scores(model, F.col("features"))
    scored = table.select(F.col("key").alias(doc_id), held_out(F.col("key")).alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
