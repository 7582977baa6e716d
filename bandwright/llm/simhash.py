"""Near-duplicates by SimHash, found through deletion variants.

Two 64-bit fingerprints that differ in at most five bits, cut into three segments, have a segment that differs in at
most one bit. So every fingerprint is indexed under each of its segments with each one bit made a wildcard, 64 keys, and
under the three segments as they are. Fingerprints that meet under a key are verified on all 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .common import BROADCAST_BYTES, arrow_function, group_key, package_on_workers, shielded, staged, unshielded
from .components import components

BITS = 64
SEGMENTS = 3
#: With one differing bit allowed in a segment, so many bits in all leave one of three segments with at most one.
MOST_BITS = 2 * SEGMENTS - 1
SEED = 42
#: Beyond, the members of a key are told apart by more bits.
MOST_UNDER_KEY = 4096
_BLOCK = 1 << 16
#: Members of a group that are compared with all others step by step; beyond, the rows of a block.
_SMALL, _ROWS = 64, 64


def shingle_hashes(text: bytes, size: int) -> list[int]:
    """XXH64 of every run of `size` words of the ASCII-lowered text, in order, repeats included."""
    words = text.lower().split()
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= size:
        return [xxhash.xxh64_intdigest(joined, SEED)]
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths)
    starts = ends - lengths
    digest = xxhash.xxh64_intdigest
    return [
        digest(joined[i:j], SEED)
        for i, j in zip(starts[: len(words) - size + 1].tolist(), (ends[size - 1 :] - 1).tolist())
    ]


def simhash(hashes: list[int]) -> int:
    """The bits set in more than half of the hashes; 0 for none."""
    if not hashes:
        return 0
    votes = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), _BLOCK):
        block = np.array(hashes[at : at + _BLOCK], "<u8")
        bits = np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: Column, size: int = 4) -> Column:
    """The fingerprint of each text as a long (its 64 bits, signed); 0 for NULL and for text without words."""

    def of(batch: pa.Array) -> pa.Array:
        out = np.zeros(len(batch), np.uint64)
        for i, value in enumerate(batch):
            if value.is_valid:
                out[i] = simhash(shingle_hashes(value.as_buffer().to_pybytes(), size))
        return pa.array(out.view(np.int64))

    return arrow_function(of, "long")(F.coalesce(text, F.lit("")))


def _bounds(width: int) -> list[tuple[int, int]]:
    return [(width * k // SEGMENTS, width * (k + 1) // SEGMENTS) for k in range(SEGMENTS)]


def _pieces(value: Column, width: int) -> list[tuple[int, Column, int]]:
    """First bit, content and length of the segments of the lowest `width` bits."""
    return [
        (low, F.shiftrightunsigned(value, low).bitwiseAND((1 << (high - low)) - 1), high - low)
        for low, high in _bounds(width)
    ]


def _keys(fp: Column) -> Column:
    """The index keys of a fingerprint: each segment with each one bit made a wildcard (number of the bit, then the rest
    of the segment), and each segment as it is (64 and its number)."""
    keys = []
    for k, (low, piece, length) in enumerate(_pieces(fp, BITS)):
        keys += [piece.bitwiseAND(~(1 << bit)).bitwiseOR(F.lit((low + bit) << 32)) for bit in range(length)]
        keys.append(piece.bitwiseOR(F.lit((BITS + k) << 32)))
    return F.array(*keys)


def _deeper_keys(fp: Column, key: Column, at: Column) -> Column:
    """For fingerprints that agree in a segment: the other bits cut into three again, with one-wildcard variants."""
    keys = None
    for k, (low, high) in enumerate(_bounds(BITS)):
        turned = fp
        if high < BITS:
            turned = F.shiftrightunsigned(fp, high).bitwiseOR(F.shiftleft(fp, BITS - high))
        variants = [
            F.xxhash64(key, F.lit(first + bit), piece.bitwiseAND(~(1 << bit)))
            for first, piece, length in _pieces(turned, BITS - (high - low))
            for bit in range(length)
        ]
        here = at.between(low, high - 1) | (at == BITS + k)
        keys = F.when(here, F.array(*variants)) if keys is None else keys.when(here, F.array(*variants))
    return keys


class _Forest:
    """Which rows are joined already; a link is new if it joins two trees."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    def join(self, i: int, j: int) -> bool:
        a, b = self.root(i), self.root(j)
        self.parent[max(a, b)] = min(a, b)
        return a != b


def _few_links(prints: np.ndarray, side: np.ndarray, group: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Links that span what near rows of the same group join, rows sorted by group; `side` as in `spanning_links`."""
    forest, found, left = _Forest(len(prints)), [], np.arange(len(prints))
    for step in range(1, len(prints)):
        left = left[left + step < len(prints)]
        left = left[group[left] == group[left + step]]
        if not len(left):
            break
        other = left + step
        near = np.bitwise_count(prints[left] ^ prints[other]) <= bits
        near &= (side[left] != side[other]) | (side[left] == 2)
        found += [(i, j) for i, j in zip(left[near].tolist(), other[near].tolist()) if forest.join(i, j)]
    return found


def _many_links(prints: np.ndarray, side: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """The same for one large group, in blocks; rows that are joined already are told apart by their labels at once."""
    n, found, label = len(prints), [], np.arange(len(prints))
    for start in range(0, n, _ROWS):
        rows = np.arange(start, min(n, start + _ROWS))
        for at in range(start, n, _BLOCK // 4):
            others = np.arange(at, min(n, at + _BLOCK // 4))
            near = np.bitwise_count(prints[rows, None] ^ prints[None, others]) <= bits
            near &= (side[rows, None] != side[None, others]) | (side[rows, None] == 2)
            near &= label[rows, None] != label[None, others]
            i, j = np.nonzero(near)
            if not len(i):
                continue
            i, j = rows[i], others[j]
            # One link for each two trees is enough.
            _, first = np.unique(label[i] * n + label[j], return_index=True)
            i, j = i[first], j[first]
            trees, numbers = np.unique(np.concatenate([label[i], label[j]]), return_inverse=True)
            forest, ends = _Forest(len(trees)), numbers.reshape(2, -1).T.tolist()
            found += [(x, y) for x, y, (a, b) in zip(i.tolist(), j.tolist(), ends) if forest.join(a, b)]
            roots = trees[[forest.root(t) for t in range(len(trees))]]
            place = np.minimum(np.searchsorted(trees, label), len(trees) - 1)
            label = np.where(trees[place] == label, roots[place], label)
    return found


def spanning_links(prints: np.ndarray, at: np.ndarray, keys: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Rows sorted by `at` and `keys`, whole groups only: links (two row numbers) between near rows of a group, as many as
    join what all such links would join.

    Where bit `at` is the wildcard, only rows that differ in it are compared: the others meet under the whole segment.
    """
    change = np.r_[True, (at[1:] != at[:-1]) | (keys[1:] != keys[:-1])]
    starts = np.flatnonzero(change)
    sizes = np.diff(np.r_[starts, len(prints)])
    group = np.cumsum(change) - 1
    side = np.where(at < BITS, (prints >> (at % BITS).astype(np.uint64)) & np.uint64(1), 2).astype(np.int8)
    # Groups that lie on one side of their wildcard have nothing to compare.
    low, high = np.minimum.reduceat(side, starts), np.maximum.reduceat(side, starts)
    worth = (sizes > 1) & ((low != high) | (low == 2))
    rows = np.flatnonzero(worth[group] & (sizes[group] <= _SMALL))
    found = [(int(rows[i]), int(rows[j])) for i, j in _few_links(prints[rows], side[rows], group[rows], bits)]
    for start, size in zip(starts[worth & (sizes > _SMALL)].tolist(), sizes[worth & (sizes > _SMALL)].tolist()):
        part = slice(start, start + size)
        found += [(start + i, start + j) for i, j in _many_links(prints[part], side[part], bits)]
    return found


def _links_of_groups(bits: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[tuple[np.ndarray, ...]] = []

        def out() -> pa.RecordBatch:
            at, keys, prints = (np.concatenate(column) for column in zip(*rest))
            found = np.array(spanning_links(prints, at, keys, bits), np.int64).reshape(-1, 2)
            ends = [pa.array(prints.view(np.int64)[found[:, end]]) for end in (0, 1)]
            return pa.RecordBatch.from_arrays(ends, ["fp", "other"])

        for batch in batches:
            if not batch.num_rows:
                continue
            at, keys, prints = (column.to_numpy() for column in batch.columns)
            prints = prints.view(np.uint64)
            new = np.flatnonzero((at != at[-1]) | (keys != keys[-1]))
            cut = int(new[-1]) + 1 if len(new) else 0
            ended = cut or rest and (rest[-1][0][-1], rest[-1][1][-1]) != (at[0], keys[0])
            if ended:
                rest.append((at[:cut], keys[:cut], prints[:cut]))
                yield out()
                rest = []
            rest.append((at[cut:], keys[cut:], prints[cut:]))
        if rest:
            yield out()

    return of


def linked_fingerprints(fingerprints: DataFrame, bits: int = 4) -> DataFrame:
    """`node` and `label` of all fingerprints (a stored frame of distinct `fp`) that a chain of links joins to others.

    1. Every fingerprint is indexed under 67 keys. Members of a key are counted by partial aggregation.
    2. Keys of more than `MOST_UNDER_KEY` members get deeper keys: what agrees in a segment is cut into three again.
    3. Each group meets in one task, where its members are compared on all 64 bits. Of all links in a group only as many
       come out as join the same fingerprints, less than one for each member, so no cluster is expanded into pairs.

    Every link lies within some group, and what it joins is joined there, so the components are exact.
    """
    if not 0 <= bits <= MOST_BITS:
        raise ValueError(f"bits must be from 0 to {MOST_BITS}, not {bits}")
    package_on_workers(fingerprints.sparkSession)
    index = fingerprints.select("fp", F.explode(_keys(F.col("fp"))).alias("key"))
    index = index.select(F.shiftright("key", 32).cast("int").alias("at"), "key", "fp")
    counts = index.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > MOST_UNDER_KEY)
    large = staged(counts, "simhash-keys")
    n = large.count()
    if n:
        keys = large.select("key")
        keys = F.broadcast(keys) if n * 64 <= BROADCAST_BYTES else keys
        deeper = F.explode(_deeper_keys(F.col("fp"), F.col("key"), F.col("at")))
        crowded = index.join(keys, "key", "left_semi").select("at", deeper.alias("key"), "fp")
        index = index.join(keys, "key", "left_anti").select("at", "key", "fp").unionByName(crowded)
    grouped = index.repartition("at", "key").sortWithinPartitions("at", "key")
    links = grouped.mapInArrow(_links_of_groups(bits), "fp long, other long")
    return components(staged(links.distinct(), "simhash-links"), "fp", "other")


def identity(doc_id: Column, text: Column) -> list[Column]:
    return [
        F.xxhash64(group_key(doc_id), text).alias("a"),
        F.xxhash64(text, group_key(doc_id), F.lit(1)).alias("b"),
    ]


def _assigned(docs: DataFrame, text: str, doc_id: str, words: int, bits: int) -> DataFrame:
    """Per document: id, identity, fingerprint, component and the identity of the one that stands for it."""
    inner, names = shielded(docs, text, doc_id)
    body, key = F.col(names[text]), F.col(names[doc_id])
    rows = staged(
        inner.select(key.alias("id"), *identity(key, body), fingerprint(body, words).alias("fp")), "simhash-rows"
    )
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "a", "b"))
    groups = staged(rows.groupBy("fp").agg(first.alias("first"), F.count(F.lit(1)).alias("n")), "simhash-groups")
    labels = linked_fingerprints(groups.select("fp"), bits).withColumnRenamed("node", "fp")
    return first_of_component(rows, groups, labels)


def first_of_component(rows: DataFrame, groups: DataFrame, labels: DataFrame) -> DataFrame:
    """Add `first` of the component to the rows; NULL for a row that is alone."""
    linked = groups.join(labels, "fp")
    least = linked.groupBy("label").agg(F.min("first").alias("first"))
    joined = linked.select("fp", "label").join(least, "label").select("fp", "first")
    alone = groups.where("n > 1").join(labels, "fp", "left_anti").select("fp", "first")
    return rows.join(joined.unionByName(alone), "fp", "left")


def near_duplicates(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = 4, bits: int = 4
) -> DataFrame:
    """One row per document: `doc_id`, `fingerprint` (16 hex digits) and `component_id`, the smallest id reachable
    over links of fingerprints that differ in at most `bits` bits.

    * Shingles are runs of `words` words of the text, A-Z lowered, separated by ASCII white space; repeats count. A
      shorter text is one shingle; a text without words (or NULL) has fingerprint 0, linked like any other.
    * Equal fingerprints are one node; copies are never expanded into pairs. Repeated rows keep their row each. A NULL
      id is the smallest only if a component has no other.
    * `bits` may be at most `MOST_BITS`; above, three segments could all differ in two bits.
    * No rows in, no rows out. Other columns of the input play no part.

    Texts are read once and hashed in Arrow batches; only fingerprints are shuffled.
    """
    assigned = _assigned(docs, text, doc_id, words, bits)
    return assigned.select(
        F.col("id").alias(doc_id),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.coalesce("first.id", "id").alias("component_id"),
    )


def deduplicate(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = 4, bits: int = 4
) -> DataFrame:
    """The documents that stand for their component: the smallest id of each. All columns stay.

    Rows equal in id and text count as one document, of which one row stays. See `near_duplicates` for the rest.
    """
    return standing(docs, _assigned(docs, text, doc_id, words, bits), text, doc_id)


def standing(docs: DataFrame, assigned: DataFrame, text: str, doc_id: str) -> DataFrame:
    """The documents that are `first` of their component or alone, once each."""
    assigned = staged(assigned.select("a", "b", "first"), "simhash-assigned")
    gone = assigned.where((F.col("first.a") != F.col("a")) | (F.col("first.b") != F.col("b")))
    inner, names = shielded(docs, text, doc_id)
    marked = inner.select("*", *identity(F.col(names[doc_id]), F.col(names[text])))
    kept = marked.join(gone.select("a", "b").distinct(), ["a", "b"], "left_anti")
    if not assigned.where("first.a = a AND first.b = b").groupBy("a", "b").count().where("count > 1").isEmpty():
        kept = kept.dropDuplicates(["a", "b"])
    return unshielded(kept, docs.columns, {})
