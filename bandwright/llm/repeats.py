"""Passages that stand in several documents, found in suffix trees that are partitioned by prefix.

A suffix starts at every word that `window` words follow or fill. Those that agree in `window` words meet in one node of
the corpus's suffix tree at that depth, so a node that deep with two documents below it is a repeat, and neighbouring
starts make up the maximal repeat. The tree is never whole anywhere:

1. Every window is known by its anchor, the shingle of `PREFIX` words inside it with the smallest hash. Equal windows have
   equal anchors, and neighbouring windows mostly share theirs, so one word in twenty is an anchor. Windows whose anchor
   stands in one text only cannot repeat and leave here.
2. An anchor of at most `MOST` stretches (consecutive windows of one anchor, less than two windows long) is the prefix of
   one group, of whose suffixes one task builds the subtree in memory (`deep_nodes`). Groups follow each other in a
   partition, sorted; one is held at a time.
3. An anchor of more stretches is too short a prefix. Equal stretches become one first, whose smallest document partial
   aggregation finds: all others repeat it whole. If at most `MOST` are left, they are a group as in 2. If not, they are
   cut into pieces by where the anchor lies in the windows, and the words that all windows of such a piece have in common
   are a longer prefix; pieces are treated as the stretches were (`repeats_in`). The last cut leaves single windows, of
   which those with one prefix are equal. So a passage of very many documents takes a row for each of its stretches, not
   for each of its words, and no task gathers it.

Equal texts and equal stretches are one throughout. Nothing is sampled or capped, and no pair of documents is formed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .common import BROADCAST_BYTES, SALTS, arrow_function, package_on_workers, shielded, staged, unshielded

WINDOW = 50
PREFIX = 8
#: Stretches under one prefix, about 1 MB of text.
MOST = 2048
#: Stretches of small groups whose subtrees are built at once.
TOGETHER = 1024
_TIMES = np.random.default_rng(12).integers(0, 1 << 64, PREFIX + 1, np.uint64) | np.uint64(1)


def _shingles(words: list[bytes], window: int) -> np.ndarray:
    """For every window of the words: the hashes of the shingles inside it."""
    size = min(PREFIX, window)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    mixed = np.zeros(len(words) - size + 1, np.uint64)
    for i in range(size):
        mixed += hashes[i : i + len(mixed)] * _TIMES[i]
    mixed ^= mixed >> np.uint64(31)
    mixed *= _TIMES[PREFIX]
    mixed ^= mixed >> np.uint64(29)
    return np.lib.stride_tricks.sliding_window_view(mixed, window - size + 1)


def anchors(words: list[bytes], window: int) -> np.ndarray:
    """For every window of the words: its anchor, a hash."""
    if len(words) < window:
        return np.zeros(0, np.int64)
    return _shingles(words, window).min(axis=1).view(np.int64)


def stretches(anchor: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last window of each stretch: neighbours with one anchor, at most `window` of them."""
    change = np.r_[True, anchor[1:] != anchor[:-1]][: len(anchor)]
    first = np.flatnonzero(change)
    inside = np.arange(len(anchor)) - np.repeat(first, np.diff(np.r_[first, len(anchor)]))
    starts = np.flatnonzero(inside % window == 0)
    return starts, np.r_[starts[1:], len(anchor)][: len(starts)] - 1


def _words(value: pa.Scalar) -> list[bytes]:
    return value.as_buffer().to_pybytes().split() if value.is_valid else []


def anchored(text: Column, window: int) -> Column:
    """The different anchors of the text's windows, each with the number of its stretches."""

    def of(batch: pa.Array) -> pa.Array:
        found, counts = [], []
        for value in batch:
            anchor = anchors(_words(value), window)
            different, n = np.unique(anchor[stretches(anchor, window)[0]], return_counts=True)
            found.append(different)
            counts.append(n)
        flat = [pa.array(np.concatenate([*parts, np.zeros(0, np.int64)])) for parts in (found, counts)]
        return _nested([len(x) for x in found], dict(zip(("anchor", "n"), flat)))

    return arrow_function(of, "array<struct<anchor: long, n: long>>")(text)


def _suffixes(words: list[bytes], window: int, *sets: np.ndarray) -> list[tuple]:
    """For each set of anchors, their stretches: anchors, places of the first word and of the one after the last, words."""
    anchor = anchors(words, window)
    starts, ends = stretches(anchor, window)
    ends += window
    found = []
    for some in sets:
        chosen = np.isin(anchor[starts], some)
        first, after = starts[chosen], ends[chosen]
        bodies = [b" ".join(words[i:j]) for i, j in zip(first.tolist(), after.tolist())]
        found.append((anchor[first], first, after, bodies))
    return found


def cells(window: int) -> list[int]:
    """How many neighbouring places of the anchor in the window share a prefix, from cut to cut; 1 at last."""
    found = [1]
    while found[0] * 4 <= window - min(PREFIX, window):
        found.insert(0, found[0] * 4)
    return found


def _pieces(words: list[bytes], window: int, cell: int) -> list[tuple[int, int, int, bytes]]:
    """The pieces of a stretch: consecutive windows with the first anchor of each in one place and at a distance from the
    window's start that is in one cell of that many distances. Prefix (a hash of what all windows of the cell have in
    common), places of the first word and of the one after the last, words."""
    inside = _shingles(words, window)
    distance = inside.argmin(axis=1)
    low = distance // cell * cell
    high = np.minimum(low + cell - 1, inside.shape[1] - 1)
    place = np.arange(len(inside)) + distance
    starts = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (low[1:] != low[:-1])])
    ends = np.r_[starts[1:], len(inside)] - 1 + window
    found = []
    for i, j in zip(starts.tolist(), ends.tolist()):
        common = b" ".join(words[place[i] - low[i] : place[i] - high[i] + window])
        found.append((xxhash.xxh3_64_intdigest(common, int(low[i])) - (1 << 63), i, j, b" ".join(words[i:j])))
    return found


def _nested(counts: list[int], fields: dict[str, pa.Array]) -> pa.ListArray:
    inner = pa.StructArray.from_arrays(list(fields.values()), list(fields))
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *counts], dtype=np.int32)), inner)


_STRETCHES = "array<struct<anchor: long, at: long, to: long, words: string>>"


def _stretches(counts: list[int], anchor: pa.Array, at: pa.Array, to: pa.Array, words: list[bytes]) -> pa.ListArray:
    fields = {"anchor": anchor, "at": at, "to": to, "words": pa.array(words, pa.binary()).cast(pa.string())}
    return _nested(counts, fields)


def _suffixes_of(text: Column, few: Column, many: Column, window: int) -> Column:
    def of(texts: pa.Array, few: pa.Array, many: pa.Array) -> pa.Array:
        rows = [
            _suffixes(_words(value), window, *(np.array(x.as_py() or [], np.int64) for x in sets))
            for value, *sets in zip(texts, few, many)
        ]
        lists = []
        for k in range(2):
            *numbers, bodies = zip(*(row[k] for row in rows)) if rows else ((),) * 4
            flat = [pa.array(np.concatenate([*parts, np.zeros(0, np.int64)])) for parts in numbers]
            lists.append(_stretches([len(x) for x in bodies], *flat, [body for part in bodies for body in part]))
        return pa.StructArray.from_arrays(lists, ["few", "many"])

    return arrow_function(of, f"struct<few: {_STRETCHES}, many: {_STRETCHES}>")(text, few, many)


def _pieces_of(words: Column, window: int, cell: int) -> Column:
    def of(batch: pa.Array) -> pa.Array:
        rows = [_pieces(_words(value), window, cell) for value in batch]
        *numbers, bodies = zip(*(piece for row in rows for piece in row)) if any(rows) else ((),) * 4
        return _stretches([len(row) for row in rows], *(pa.array(x, pa.int64()) for x in numbers), bodies)

    return arrow_function(of, _STRETCHES)(words)


def deep_nodes(tokens: np.ndarray, ends: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffix tree's nodes at a depth with more than one suffix below them.

    `tokens` are the words of all stretches one after the other, as numbers; `ends` is, for each word, where its stretch
    ends. The tree is built level by level, at 1, 2, 4, ... words and at `depth`: two suffixes are in one node of the next
    level if they are in one node of this one and what follows, as many words on as are missing, is too. A suffix alone in
    its node is a leaf and goes no deeper. Returns the places of the suffixes that reach `depth`, and their nodes.
    """
    places, reached = np.arange(len(tokens)), 1
    _, number, count = np.unique(tokens, return_inverse=True, return_counts=True)
    node = np.where(count[number] > 1, number, -1)
    while reached < depth:
        step = min(reached, depth - reached)
        reached += step
        deeper = places[(places + reached <= ends) & (node >= 0)]
        deeper = deeper[node[deeper + step] >= 0]
        pairs = node[deeper] * (int(node.max(initial=0)) + 1) + node[deeper + step]
        _, number, count = np.unique(pairs, return_inverse=True, return_counts=True)
        node = np.full(len(tokens), -1)
        node[deeper] = np.where(count[number] > 1, number, -1)
    places = np.flatnonzero(node >= 0)
    return places, node[places]


def repeated_spans(stretches: pa.Table, window: int) -> pa.Table:
    """Spans of words, `a b start end`, in windows that a stretch of a smaller id has too. Whole groups only."""
    bodies = [value.as_buffer().to_pybytes().split(b" ") for value in stretches["words"].combine_chunks()]
    lengths = np.fromiter(map(len, bodies), np.int64, len(bodies))
    ends = np.cumsum(lengths)
    numbers: dict[bytes, int] = {}
    tokens = np.fromiter((numbers.setdefault(w, len(numbers)) for body in bodies for w in body), np.int64, int(ends[-1]))
    owner = np.repeat(np.arange(len(bodies)), lengths)
    alive, node = deep_nodes(tokens, ends[owner], window)
    # NULL ids come after all others and are equal among themselves.
    ids = stretches["id"].to_pandas()
    rank, known = ids.factorize(sort=True)
    rank = np.where(rank < 0, len(known), rank)[owner[alive]]
    least = np.full(int(node.max()) + 1 if len(node) else 0, len(known) + 1)
    np.minimum.at(least, node, rank)
    alive = alive[rank > least[node]]
    row = owner[alive]
    at = alive - (ends - lengths)[row] + stretches["at"].to_numpy()[row]
    first = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (at[1:] != at[:-1] + 1)][: len(at)])
    final = np.r_[first[1:], len(at)][: len(first)] - 1
    picked = stretches.select(["a", "b"]).take(pa.array(row[first]))
    return picked.append_column("start", pa.array(at[first])).append_column("end", pa.array(at[final] + window))


def _subtrees(window: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            rows = rows if rest is None else pa.concat_tables([rest, rows])
            # Whole groups, some small ones together; the last may go on in the next batch.
            prefix = rows["anchor"].to_numpy()
            starts = np.flatnonzero(np.r_[True, prefix[1:] != prefix[:-1]])
            done = 0
            while done < starts[-1]:
                cut = int(starts[min(np.searchsorted(starts, done + TOGETHER), len(starts) - 1)])
                yield from repeated_spans(rows.slice(done, cut - done), window).to_batches()
                done = cut
            rest = rows.slice(done)
        if rest is not None:
            yield from repeated_spans(rest, window).to_batches()

    return of


def _met(rows: DataFrame, facts: DataFrame, keys: list[str], width: int, how: str = "inner") -> DataFrame:
    """Join with a staged table of at most one row per key: broadcast if its rows, `width` bytes each, are few enough."""
    return rows.join(F.broadcast(facts) if facts.count() * width <= BROADCAST_BYTES else facts, keys, how)


def _found(stretches: DataFrame, window: int) -> DataFrame:
    """The spans of `repeated_spans`, one group per anchor."""
    package_on_workers(stretches.sparkSession)
    return (
        stretches.repartition("anchor")
        .sortWithinPartitions("anchor")
        .mapInArrow(_subtrees(window), "a long, b long, start long, end long")
    )


def repeats_in(pieces: DataFrame, window: int, cuts: list[int]) -> DataFrame:
    """Spans of words, `a b start end`, in windows that a piece of a smaller place has too.

    `pieces` has the words from `at` to `to` of what `a` and `b` name: consecutive windows that meet all equal ones under
    `anchor`. Any number may have one anchor, and any number of them the same words. `cuts` are the `cells` still to come.
    """
    pieces = staged(
        pieces.select("*", F.xxhash64("words").alias("w1"), F.xxhash64(F.lit(1), "words").alias("w2")), "repeats-pieces"
    )
    bodies = staged(
        pieces.groupBy("w1", "w2").agg(
            F.min("place").alias("place"), F.first("anchor").alias("anchor"), F.first("words").alias("words"), F.count(F.lit(1)).alias("n")
        ),
        "repeats-bodies",
    )
    sizes = bodies.groupBy("anchor").agg(F.count(F.lit(1)).alias("bodies"))
    sizes = staged(sizes.where("bodies > 1"), "repeats-sizes")
    known = bodies.withColumnsRenamed({"w1": "a", "w2": "b"})
    # Broadcast: at most one anchor for `MOST` bodies.
    crowded = sizes.where(F.col("bodies") > MOST).select("anchor")
    deeper = bool(cuts) and not crowded.isEmpty()
    groups = known.join(F.broadcast(crowded), "anchor", "left_anti") if deeper else known
    groups = _met(groups, sizes.select("anchor"), ["anchor"], 64)
    found = _found(groups.select("a", "b", "place.id", "anchor", F.lit(0).cast("long").alias("at"), "words"), window)
    if deeper:
        cut = known.join(F.broadcast(crowded), "anchor", "left_semi")
        cut = cut.select("a", "b", "place", F.explode(_pieces_of(F.col("words"), window, cuts[0])).alias("s"))
        found = found.unionByName(repeats_in(cut.select("a", "b", "place", "s.*"), window, cuts[1:]))
    span = F.struct("start", "end")
    spans = found.groupBy(F.col("a").alias("w1"), F.col("b").alias("w2")).agg(F.collect_set(span).alias("spans"))
    spans = staged(spans, "repeats-parts")
    # The pieces of the smallest place have what was found for their words; all others go whole.
    copied = bodies.where("n > 1").select("w1", "w2", F.col("place").alias("least"))
    placed = _met(pieces.drop("anchor", "words"), copied, ["w1", "w2"], 128, "left")
    later = F.coalesce(F.col("place") > F.col("least"), F.lit(False))
    whole = placed.where(later).select("a", "b", F.col("at").alias("start"), F.col("to").alias("end"))
    parts = _met(placed.where(~later), spans, ["w1", "w2"], 256).select("a", "b", "at", F.explode("spans").alias("s"))
    at = F.col("at")
    return whole.unionByName(parts.select("a", "b", (at + F.col("s.start")).alias("start"), (at + F.col("s.end")).alias("end")))


def _keyed(docs: DataFrame, text: str, doc_id: str) -> tuple[DataFrame, dict[str, str]]:
    inner, names = shielded(docs, text, doc_id)
    body, key = F.coalesce(F.col(names[text]), F.lit("")), F.col(names[doc_id])
    order = F.struct(key.isNull().alias("none"), key.alias("id"))
    return inner.select(
        "*", F.xxhash64(body).alias("a"), F.xxhash64(F.lit(1), body).alias("b"), body.alias("body"), order.alias("place")
    ), names


def repeated_words(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = WINDOW) -> DataFrame:
    """Per different text, known by its hashes `a` and `b`: `least`, its smallest id (a struct), `spans`, the spans of
    words (start, end; not merged) that repeat in a text of a smaller id. Only texts with copies or spans have a row."""
    keyed, _ = _keyed(docs, text, doc_id)
    light = staged(
        keyed.select("a", "b", "place", anchored(F.col("body"), window).alias("anchors"))
        .groupBy("a", "b")
        .agg(F.min("place").alias("least"), F.max("place").alias("most"), F.count(F.lit(1)).alias("n"), F.first("anchors").alias("anchors")),
        "repeats-texts",
    )
    spread = light.select("a", "b", F.explode("anchors").alias("s")).select("a", "b", "s.*")
    counts = spread.groupBy("anchor").agg(F.count(F.lit(1)).alias("texts"), F.sum("n").alias("stretches"))
    counts = staged(counts.where("texts > 1").select("anchor", "stretches"), "repeats-anchors")
    if counts.count() * 64 <= BROADCAST_BYTES:
        shared = spread.join(F.broadcast(counts), "anchor")
    else:  # An anchor of very many texts is spread over salts.
        salted = counts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        shared = spread.withColumn("salt", F.pmod("a", F.lit(SALTS)).cast("int")).join(salted, ["anchor", "salt"])
    few, many = (F.when(F.col("stretches") <= MOST, F.col("anchor")), F.when(F.col("stretches") > MOST, F.col("anchor")))
    wanted = staged(
        shared.groupBy("a", "b").agg(F.collect_list(few).alias("few"), F.collect_list(many).alias("many")),
        "repeats-wanted",
    )
    # One row of each text is read again: that of its smallest id, or one of several that are equal.
    least = light.select("a", "b", F.col("least").alias("place"), "n")
    first = staged(wanted.join(least, ["a", "b"]), "repeats-first")
    size = first.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.size("few") + F.size("many")).alias("m"),
        F.sum(F.size("many")).alias("many"),
        F.max("n").alias("most"),
    ).first()
    small = size.n * 96 + 8 * (size.m or 0) <= 2 * BROADCAST_BYTES
    texts = keyed.select("a", "b", "place", "body").join(F.broadcast(first) if small else first, ["a", "b", "place"])
    if (size.most or 0) > 1:
        texts = texts.dropDuplicates(["a", "b"])
    suffixes = staged(
        texts.select("a", "b", "place", _suffixes_of(F.col("body"), F.col("few"), F.col("many"), window).alias("s"))
        .select("a", "b", "place", "s.few", "s.many"),
        "repeats-suffixes",
    )
    rare, frequent = (
        suffixes.select("a", "b", "place", F.explode(name).alias("s")).select("a", "b", "place", "s.*")
        for name in ("few", "many")
    )
    spans = _found(rare.select("a", "b", "place.id", "anchor", "at", "words"), window)
    if size.many:
        spans = spans.unionByName(repeats_in(frequent, window, cells(window)))
    span = F.struct("start", "end")
    spans = spans.groupBy("a", "b").agg(F.collect_set(span).alias("spans"))
    copied = light.where("least <> most OR (least IS NULL) <> (most IS NULL)").select("a", "b")
    known = spans.join(copied, ["a", "b"], "full").join(light.select("a", "b", "least"), ["a", "b"])
    return staged(known.select("a", "b", "least", F.coalesce("spans", F.array()).alias("spans")), "repeats-spans")


def _kept(value: pa.Scalar, cuts: pa.Scalar, gone: bool, window: int) -> tuple[int, int, str]:
    words = _words(value)
    covered = np.zeros(len(words) + 1, np.int64)
    if gone and len(words) >= window:
        covered[0], covered[-1] = 1, -1
    elif cuts.is_valid and len(cuts):
        np.add.at(covered, cuts.values.field("start").to_numpy(), 1)
        np.add.at(covered, cuts.values.field("end").to_numpy(), -1)
    left = np.flatnonzero(np.cumsum(covered)[:-1] == 0)
    kept = words if len(left) == len(words) else [words[i] for i in left.tolist()]
    return len(words), len(words) - len(left), b" ".join(kept).decode()


def _without(text: Column, spans: Column, whole: Column, window: int) -> Column:
    """Struct of `n_words`, `n_removed` and `kept`, the words left with one space between them."""

    def of(texts: pa.Array, spans: pa.Array, whole: pa.Array) -> pa.Array:
        rows = [_kept(value, cuts, gone.as_py(), window) for value, cuts, gone in zip(texts, spans, whole)]
        kinds = {"n_words": pa.int64(), "n_removed": pa.int64(), "kept": pa.string()}
        columns = zip(*rows) if rows else ((),) * 3
        return pa.StructArray.from_arrays([pa.array(x, kind) for x, kind in zip(columns, kinds.values())], list(kinds))

    return arrow_function(of, "struct<n_words: long, n_removed: long, kept: string>")(text, spans, whole)


def remove_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = WINDOW) -> DataFrame:
    """All columns, then `n_words`, `n_removed` and `kept_text`: the words of the text, one space between them, without
    those in a run of `window` words that also stands in a document with a smaller id.

    * Words are runs of anything but ASCII white space, unchanged. NULL or empty text has none, and nothing is removed.
    * All windows are judged on the input: what is removed elsewhere does not matter. Repeats inside one document stay.
    * Ids order the documents; NULL ids come last. Of rows with equal ids (repeated rows, NULLs) none is smaller, so they
      do not remove from each other. Shorter texts than a window keep every word, copies too.
    * An input column named like one of the three gives way. No rows in, no rows out.

    Texts are read three times: for their anchors, for the words around shared ones, for the result.
    """
    if window < 1:
        raise ValueError(f"a window must have a word at least, not {window}")
    known = repeated_words(docs, text, doc_id, window)
    keyed, _ = _keyed(docs, text, doc_id)
    size = known.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("spans")).alias("m")).first()
    small = size.n * 96 + 16 * (size.m or 0) <= 2 * BROADCAST_BYTES
    joined = keyed.join(F.broadcast(known) if small else known, ["a", "b"], "left")
    whole = F.coalesce(F.col("place") > F.col("least"), F.lit(False))
    result = joined.withColumn("r", _without(F.col("body"), F.col("spans"), whole, window))
    outputs = {"n_words": F.col("r.n_words"), "n_removed": F.col("r.n_removed"), "kept_text": F.col("r.kept")}
    return unshielded(result, docs.columns, outputs)
