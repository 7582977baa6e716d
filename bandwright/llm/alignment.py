"""How two tokenizers cut the same texts: groups of tokens that end together, and counts of the pairs that overlap.

1. A first pass over the documents finds, per task, in how many of its documents each pair of ids is linked.
2. The distinct pairs get a minimal perfect hash (`PairIndex`): every pair has its own place in 0 ... n - 1, and the pair
   that owns a place is kept there, so a pair that is not indexed is told apart. Tasks add their counts up in dense vectors
   by place, and the vectors are summed as a tree, in slices.
3. A second pass aligns the documents again and looks the counts up.

The pairs are bounded by the two vocabularies, but only loosely. They are counted before anything is sent to the driver or
to all executors; above `MOST_PAIRS` the counts stay a Spark table, and links are joined to it.
"""

from __future__ import annotations

import functools
import json
import os
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress, islice

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import arrow_function, blocks_of, package_on_workers, shielded, staged, unshielded

BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_BPE = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Pairs of which every executor can hold 16 bytes.
MOST_PAIRS = 8_000_000
#: Tasks that hold a whole vector of counts, how many meet in a first sum, and the places of a slice.
VECTORS, FAN, SLICE = 128, 16, 1 << 16
#: Characters of the documents read at once, words known at most, entries of a task's counts before they are written.
BLOCK, CACHED, HELD = 1 << 20, 300_000, 1 << 20
#: New words that are encoded as one text.
AT_ONCE = 200
#: White space and what follows it, up to the next white space that a cut may precede.
_WORDS = re.compile(r"\s*\S+(?:[^\S \t\n]\s*\S*)*|\s+")
_INNER = re.compile(rf"[^{SPACE} \t\n][{SPACE} \t\n]")
_STABLE = re.compile(r"[\x00-\x7f\xa1-\u024f]*")
# Fixed value: where byte-level tokenizers cut a text before they merge.
BYTE_LEVEL_CUT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_values() -> dict[str, int]:
    """The characters by which a byte-level vocabulary writes bytes: printable ones stand for themselves, the others
    follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class Aligner:
    """Both tokenizers, and the words they have met.

    Neither tokenizer reaches over the start of white space behind another character, so a text is cut there into words
    with the white space in front of them, and both sides end a token at every cut: ids, groups and links of a text are
    those of its words one after the other. What a word gives is kept in arrays by the word's number, until `CACHED` words
    are known and all is learned anew.
    """

    def __init__(self, byte_bpe: str, piece_bpe: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(byte_bpe)
        self.a.encode_special_tokens = True
        value = byte_values()
        special = {token["content"] for token in json.loads(byte_bpe).get("added_tokens", [])}
        entries = {i: token for token, i in self.a.get_vocab().items()}
        self.a_bytes = [
            b"" if i not in entries else entries[i].encode() if entries[i] in special else bytes(value[c] for c in entries[i])
            for i in range(max(entries) + 1)
        ]
        self.b = sentencepiece.SentencePieceProcessor(model_proto=piece_bpe)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        if any(_INNER.search(piece) for piece in pieces):
            raise ValueError("a piece has white space behind another character: texts cannot be cut into words")
        self.b_bytes = [
            bytes([int(piece[1:-1], 16)]) if self.b.is_byte(i) else piece.replace(SPACE, " ").encode()
            for i, piece in enumerate(pieces)
        ]
        self.a_length = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_length = np.array([len(x) for x in self.b_bytes], np.int64)
        self.a_flat, self.b_flat = (np.frombuffer(b"".join(side), np.uint8) for side in (self.a_bytes, self.b_bytes))
        self.a_at, self.b_at = (np.cumsum(n) - n for n in (self.a_length, self.b_length))
        # Ids of A with a comma or the bar after them, ids of B with a comma or the semicolon.
        ids = [(f"{i},", f"{i}|") for i in range(len(self.a_bytes))], [(f"{i},", f"{i};") for i in range(len(pieces))]
        self.signs = np.array([text for side in ids for entry in side for text in entry], object)
        # Words are encoded behind a sign of their own.
        self.a_skip, self.b_skip = len(self.a.encode(" a", add_special_tokens=False).ids), len(self.b.encode("a"))
        self.fast = self._same_by_rank(json.loads(byte_bpe)["model"])
        self.forget()

    def _same_by_rank(self, model: dict) -> tiktoken.Encoding | None:
        """A's merging by rank in another library, several times faster, for text of characters that every version of
        Unicode puts into the same class (`_STABLE`); None if the merges do not come in the order of their ids."""
        merged = ["".join(pair.split(" ") if isinstance(pair, str) else pair) for pair in model["merges"]]
        order = [model["vocab"][entry] for entry in merged]
        if order != sorted(order):
            return None
        ranks = {self.a_bytes[i]: i for i in model["vocab"].values() if self.a_bytes[i]}
        return tiktoken.Encoding("a", pat_str=BYTE_LEVEL_CUT, mergeable_ranks=ranks, special_tokens={})

    def forget(self, writing: bool = False) -> None:
        self.writing = writing
        #: Words as they are met, each with the next number, and by that number the one it has in the arrays.
        self.numbers: defaultdict[str, int] = defaultdict()
        self.numbers.default_factory = self.numbers.__len__
        self.place = np.zeros(0, np.int64)
        self.groups: list[str] = []
        #: Per word: whether both sides give its bytes back, ids of A and B, groups, links.
        self.sizes = np.zeros((5, 0), np.int64)
        self.links = np.zeros(0, np.int64)
        self.starts = np.zeros(1, np.int64)
        #: Per word: links that are the best of their A id, and the sum of their counts, as looked up in `source`.
        self.counts, self.source = np.zeros((2, 0), np.int64), None

    def _of_a(self, text: str) -> list[int]:
        """A's ids of a text that follows a sign."""
        if self.fast is not None and _STABLE.fullmatch(text):
            return self.fast.encode_ordinary(" a" + text)[self.a_skip :]
        return self.a.encode(" a" + text, add_special_tokens=False).ids[self.a_skip :]

    def _of_both(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of texts that each follow a sign, one text after the other; None if a side does not give all texts back."""
        a = [np.array(self._of_a(part), np.int64) for part in parts]
        b = [np.array(self.b.encode("a" + part), np.int64)[self.b_skip :] for part in parts]
        a, b = (np.concatenate([np.zeros(0, np.int64), *side]) for side in (a, b))
        wanted = np.frombuffer("".join(parts).encode(), np.uint8)
        sides = (a, self.a_flat, self.a_at, self.a_length), (b, self.b_flat, self.b_at, self.b_length)
        return (a, b) if all(_gives(*side, wanted) for side in sides) else None

    def _ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]] | None:
        """Ids of the words one after the other, and the words in the order in which they were taken: those of letters
        that both of A's libraries know, the others, and one by one those that end in white space. None if a side does not
        give all of them back."""
        odd = [word for word in words if word[-1].isspace()]
        rest = [word for word in words if not word[-1].isspace()] if odd else words
        known = [_STABLE.fullmatch(word) is not None for word in rest]
        stable, other = list(compress(rest, known)), [] if all(known) else [w for w, k in zip(rest, known) if not k]
        # In short texts: merging keeps a queue of all neighbours of its text.
        parts = ["".join(side[at : at + AT_ONCE]) for side in (stable, other) for at in range(0, len(side), AT_ONCE)] + odd
        found = self._of_both(parts)
        return None if found is None else (*found, stable + other + odd)

    def _signs(self, a: np.ndarray, b: np.ndarray, a_group: np.ndarray, b_group: np.ndarray) -> list[str]:
        """Ids as text, group by group, those of A first."""
        a_last, b_last = (np.r_[group[1:] != group[:-1], True][: len(group)] for group in (a_group, b_group))
        signs = np.concatenate([2 * a + a_last, 2 * (len(self.a_bytes) + b) + b_last])
        order = np.argsort(np.concatenate([2 * a_group, 2 * b_group + 1]), kind="stable")
        return self.signs[signs[order]].tolist()

    def learn(self, words: list[str]) -> None:
        """Take in words that have a number and nothing else yet."""
        bad = [w for w in words if SPACE in w]
        good = [w for w in words if SPACE not in w] if bad else words
        found = self._ids(good)
        if found is None:
            same = [self._of_both([w]) is not None for w in good]
            bad += [w for w, kept in zip(good, same) if not kept]
            found = self._ids([w for w, kept in zip(good, same) if kept])
        a, b, good = found
        # Every byte but those that go on with a character starts one.
        starts = np.flatnonzero(np.frombuffer("".join([*good, "."]).encode(), np.uint8) & 0xC0 != 0x80)
        word_end = starts[np.cumsum(np.fromiter(map(len, good), np.int64, len(good)))]
        a_end, b_end = np.cumsum(self.a_length[a]), np.cumsum(self.b_length[b])
        # Between two neighbouring ends of either side lies the overlap of exactly one token of each.
        ends = _distinct(np.concatenate([a_end, b_end]))
        links = a[np.searchsorted(a_end, ends)] * len(self.b_bytes) + b[np.searchsorted(b_end, ends)]
        both = np.sort(np.concatenate([a_end, b_end]), kind="stable")
        common = both[:-1][both[1:] == both[:-1]]
        n = len(good)
        a_n, b_n, group_n, link_n = (
            np.bincount(np.searchsorted(word_end, at), minlength=n) for at in (a_end, b_end, common, ends)
        )
        if self.writing:
            signs, cuts = self._signs(a, b, np.searchsorted(common, a_end), np.searchsorted(common, b_end)), np.cumsum(a_n + b_n).tolist()
            self.groups += ["".join(signs[i:j]) for i, j in zip([0, *cuts], cuts)] + [""] * len(bad)
        taken = dict(zip([*good, *bad], range(len(self.place), len(self.numbers))))
        self.place = np.concatenate([self.place, np.fromiter(map(taken.__getitem__, words), np.int64, len(words))])
        sizes = np.zeros((5, n + len(bad)), np.int64)
        sizes[:, :n] = np.ones(n, np.int64), a_n, b_n, group_n, link_n
        self.sizes = np.concatenate([self.sizes, sizes], axis=1)
        self.links = np.concatenate([self.links, links])
        self.starts = np.concatenate([[0], np.cumsum(self.sizes[4])])

    def read(self, texts: list[str], writing: bool) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the words of the texts one after the other, and where each text ends. An empty text has none.
        `writing` says that their groups will be written."""
        if len(self.numbers) > CACHED or writing > self.writing:
            self.forget(writing)
        number, parts, ends = self.numbers.__getitem__, [np.zeros(0, np.int64)], [0]
        for text in texts:
            words = _WORDS.findall(" " + text) if text else []
            parts.append(np.fromiter(map(number, words), np.int64, len(words)))
            ends.append(ends[-1] + len(words))
        new = len(self.numbers) - len(self.place)
        if new:
            self.learn(list(islice(reversed(self.numbers), new))[::-1])
        return self.place[np.concatenate(parts)], np.array(ends[1:], np.int64)

    def links_of(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Links of the words one after the other, and how many each has."""
        n = self.sizes[4][words]
        ends = np.cumsum(n)
        return self.links[np.repeat(self.starts[words] - (ends - n), n) + np.arange(int(ends[-1]) if len(ends) else 0)], n


    def counted(self, source: PairCounts) -> np.ndarray:
        """`counts` of all words known; only those that are new are looked up."""
        if self.source is not source:
            self.counts, self.source = np.zeros((2, 0), np.int64), source
        done = self.counts.shape[1]
        first = self.starts[done]
        new = _sums(source.looked_up(self.links[first:]), self.starts[done + 1 :] - first)
        self.counts = np.concatenate([self.counts, new], axis=1)
        return self.counts


@functools.lru_cache(maxsize=2)
def aligner(byte_bpe: str, piece_bpe: bytes) -> Aligner:
    return Aligner(byte_bpe, piece_bpe)


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.r_[True, values[1:] != values[:-1]][: len(values)]]


def _gives(ids: np.ndarray, flat: np.ndarray, at: np.ndarray, length: np.ndarray, wanted: np.ndarray) -> bool:
    """Whether the bytes of the ids, kept one entry after the other, are the wanted ones."""
    n = length[ids]
    ends = np.cumsum(n)
    if (int(ends[-1]) if len(ends) else 0) != len(wanted):
        return False
    return np.array_equal(flat[np.repeat(at[ids] - (ends - n), n) + np.arange(len(wanted))], wanted)


def _sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of consecutive stretches (along the last axis) that end at `ends`; a stretch may be empty."""
    running = np.concatenate([np.zeros((*values.shape[:-1], 1), np.int64), np.cumsum(values, axis=-1)], axis=-1)
    return running[..., ends] - running[..., np.r_[0, ends[:-1]]]


@dataclass(frozen=True)
class Block:
    """Texts as word numbers: `ends` by text; `whole` texts have words and all of them come back from both sides."""

    words: np.ndarray
    ends: np.ndarray
    whole: np.ndarray
    sizes: np.ndarray

    @classmethod
    def of(cls, known: Aligner, texts: list[str], writing: bool = True) -> Block:
        words, ends = known.read(texts, writing)
        sizes = _sums(known.sizes[:, words], ends)
        length = np.diff(np.r_[0, ends])
        whole = (length > 0) & (sizes[0] == length)
        return cls(words, ends, whole, np.where(whole, sizes[1:], 0))

    def pairs(self, known: Aligner) -> np.ndarray:
        """The linked pairs of each whole text, once each, text after text."""
        text = np.repeat(np.arange(len(self.ends)), np.diff(np.r_[0, self.ends]))
        kept = self.whole[text]
        once = _distinct(text[kept] * len(known.numbers) + self.words[kept])
        links, n = known.links_of(once % len(known.numbers) if len(once) else once)
        base = len(known.a_bytes) * len(known.b_bytes)
        return _distinct(np.repeat(once // max(1, len(known.numbers)), n) * base + links) % base

    def groups(self, known: Aligner) -> list[str]:
        texts, words = [], self.words.tolist()
        for start, end, whole in zip([0, *self.ends.tolist()], self.ends.tolist(), self.whole.tolist()):
            texts.append("".join([known.groups[w] for w in words[start:end]])[:-1] if whole else "")
        return texts


def _mixed(keys: np.ndarray, level: int) -> np.ndarray:
    x = keys.astype(np.uint64) + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PairIndex:
    """A minimal perfect hash of distinct keys, with the keys by place to verify what is looked up.

    On every level a key that meets no other one in a bit field of twice as many bits as keys are left takes its bit;
    the others go on to the next level. The place of a key is the number of bits before its own.
    """

    def __init__(self, keys: np.ndarray):
        self.levels: list[tuple[int, np.ndarray, np.ndarray]] = []
        before, rest = 0, keys
        while len(rest):
            size = 64 * -(-2 * len(rest) // 64)
            at = (_mixed(rest, len(self.levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            fields = np.packbits(alone, bitorder="little").view(np.uint64)
            ones = np.bitwise_count(fields).astype(np.int64)
            self.levels.append((size, fields, before + np.cumsum(ones) - ones))
            before += int(ones.sum())
            rest = rest[~alone[at]]
        self.keys = np.zeros(before, np.int64)
        self.keys[self._place(keys)] = keys

    def __len__(self) -> int:
        return len(self.keys)

    def _place(self, keys: np.ndarray) -> np.ndarray:
        places, left = np.full(len(keys), -1), np.arange(len(keys))
        for level, (size, fields, before) in enumerate(self.levels):
            at = (_mixed(keys[left], level) % np.uint64(size)).astype(np.int64)
            field, bit = fields[at >> 6], (at & 63).astype(np.uint64)
            here = (field >> bit) & np.uint64(1) == 1
            lower = field & ((np.uint64(1) << bit) - np.uint64(1))
            places[left[here]] = (before[at >> 6] + np.bitwise_count(lower))[here]
            left = left[~here]
        return places

    def places(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key; -1 for one that is not indexed."""
        places = self._place(keys)
        if not len(self.keys):
            return places
        return np.where((places >= 0) & (self.keys[places] == keys), places, -1)


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    different, at = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.zeros(len(different), np.int64)
    np.add.at(total, at, np.concatenate(counts))
    return different, total


def _pairs_of(models):
    """Rows `pair`, `n`: in how many documents of the task a pair is linked. A pair may have several rows."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = aligner(*models.value)
        keys, counts, held = [], [], 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x) for x in _summed(keys, counts)], ["pair", "n"])

        for batch in batches:
            for texts in blocks_of(batch.column(0), BLOCK):
                different, n = np.unique(Block.of(known, texts, False).pairs(known), return_counts=True)
                keys.append(different)
                counts.append(n)
                held += len(different)
                if held > HELD:
                    whole, total = _summed(keys, counts)
                    keys, counts, held = [whole], [total], len(whole)
                    if held > HELD // 2:
                        yield out()
                        keys, counts, held = [], [], 0
        if held:
            yield out()

    return of


def _vectors(index):
    """Slices of the dense vector of a task's counts: `slice`, `part`, `counts` (longs in bytes)."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        vector = np.zeros(len(index.value), np.int64)
        for batch in batches:
            np.add.at(vector, index.value.places(batch.column(0).to_numpy()), batch.column(1).to_numpy())
        part = TaskContext.get().partitionId()
        for number, start in enumerate(range(0, len(vector), SLICE)):
            counts = vector[start : start + SLICE]
            if counts.any():
                row = [pa.array([number], pa.int32()), pa.array([part], pa.int32()), pa.array([counts.tobytes()])]
                yield pa.RecordBatch.from_arrays(row, ["slice", "part", "counts"])

    return of


def _added(rows: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(counts.as_buffer(), np.int64) for counts in rows["counts"])
    return pa.table([rows["slice"][:1], rows["part"][:1], [total.tobytes()]], ["slice", "part", "counts"])


def summed_vectors(partial: DataFrame, index) -> np.ndarray:
    """The vector of all counts: dense vectors of at most `VECTORS` tasks, summed `FAN` by `FAN` slice by slice."""
    schema = "slice int, part int, counts binary"
    rows = partial.coalesce(VECTORS).mapInArrow(_vectors(index), schema)
    parts = VECTORS
    while parts > 1:
        parts = -(-parts // FAN)
        rows = rows.withColumn("part", F.pmod("part", F.lit(parts))).groupBy("slice", "part").applyInArrow(_added, schema)
    vector = np.zeros(len(index.value), np.int64)
    for row in rows.select("slice", "counts").toLocalIterator():
        counts = np.frombuffer(row.counts, np.int64)
        vector[row.slice * SLICE : row.slice * SLICE + len(counts)] = counts
    return vector


@dataclass(frozen=True)
class PairCounts:
    """Counts by place, and the highest count of each id of A."""

    index: PairIndex
    counts: np.ndarray
    best: np.ndarray
    b_size: int

    @classmethod
    def of(cls, index: PairIndex, counts: np.ndarray, b_size: int) -> PairCounts:
        first = index.keys // b_size
        best = np.zeros(int(first.max()) + 1 if len(first) else 0, np.int64)
        np.maximum.at(best, first, counts)
        return cls(index, counts, best, b_size)

    def looked_up(self, links: np.ndarray) -> np.ndarray:
        """Two rows: whether a link's count is the highest of its A id, and the count. A pair that no document of the
        first pass linked (a word of a text that does not come back) counts 0."""
        places = self.index.places(links)
        counts = np.where(places >= 0, self.counts[places], 0) if len(self.index) else np.zeros(len(links), np.int64)
        best = (counts > 0) & (counts == self.best[np.minimum(links // self.b_size, len(self.best) - 1)]) if len(self.best) else counts > 0
        return np.stack([best.astype(np.int64), counts])


_SHAPE = {"n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(), "groups": pa.string()}
_SHAPE_DDL = "n_a: long, n_b: long, n_groups: long, n_links: long, groups: string"


def _shape(known: Aligner, block: Block) -> dict[str, pa.Array]:
    sizes = dict(zip(_SHAPE, map(pa.array, block.sizes)))
    return sizes | {"groups": pa.array(block.groups(known), pa.string())}


def _structs(blocks: list[dict[str, pa.Array]], kinds: dict[str, pa.DataType]) -> pa.StructArray:
    columns = [pa.concat_arrays([block[name] for block in blocks]) if blocks else pa.array([], kind) for name, kind in kinds.items()]
    return pa.StructArray.from_arrays(columns, list(kinds))


def _counted(models, pairs):
    def of(batch: pa.Array) -> pa.Array:
        known, counted, blocks = aligner(*models.value), pairs.value, []
        for texts in blocks_of(batch, BLOCK):
            block = Block.of(known, texts)
            counts = known.counted(counted)
            best, total = np.where(block.whole, _sums(counts[:, block.words], block.ends), 0)
            blocks.append(_shape(known, block) | {"n_best": pa.array(best), "count_sum": pa.array(total)})
        return _structs(blocks, _SHAPE | {"n_best": pa.int64(), "count_sum": pa.int64()})

    return of


def _linked(models):
    def of(batch: pa.Array) -> pa.Array:
        known, blocks, kind = aligner(*models.value), [], pa.list_(pa.int64())
        for texts in blocks_of(batch, BLOCK):
            block = Block.of(known, texts)
            links, n = known.links_of(block.words)
            of_text = np.split(links, np.cumsum(_sums(n, block.ends))[:-1])
            lists = [found if whole else np.zeros(0, np.int64) for found, whole in zip(of_text, block.whole)]
            blocks.append(_shape(known, block) | {"links": pa.array(lists, kind)})
        return _structs(blocks, _SHAPE | {"links": kind})

    return of


def _joined(rows: DataFrame, partial: DataFrame, models, b_size: int) -> DataFrame:
    """The second pass where the counts stay a table: each document's links are joined to them, equal documents once."""
    totals = partial.groupBy("pair").agg(F.sum("n").alias("count")).withColumn("a", F.expr(f"pair div {b_size}"))
    totals = staged(totals, "alignment-counts")
    best = totals.groupBy("a").agg(F.max("count").alias("best"))
    totals = staged(totals.join(F.broadcast(best), "a").select("pair", "count", (F.col("count") == F.col("best")).alias("top")), "alignment-best")
    linked = rows.select("k1", "k2", arrow_function(_linked(models), f"struct<{_SHAPE_DDL}, links: array<long>>")(F.col("body")).alias("r"))
    once = staged(linked.dropDuplicates(["k1", "k2"]), "alignment-links")
    # A frequent pair has one row for each document of a task, so its part of the join can be split.
    spread = once.select("k1", "k2", F.explode("r.links").alias("pair")).groupBy("k1", "k2", "pair").agg(F.count(F.lit(1)).alias("n"))
    sums = spread.join(totals, "pair").groupBy("k1", "k2").agg(
        F.sum(F.when(F.col("top"), F.col("n")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("count")).alias("count_sum")
    )
    whole = once.join(sums, ["k1", "k2"], "left").select(
        "k1", "k2",
        F.struct("r.n_a", "r.n_b", "r.n_groups", "r.n_links", "r.groups", F.coalesce("n_best", F.lit(0)).alias("n_best"), F.coalesce("count_sum", F.lit(0)).alias("count_sum")).alias("r"),
    )
    return rows.join(whole, ["k1", "k2"])


def align_tokenizers(
    docs: DataFrame,
    text: str = "text",
    byte_bpe: str = BYTE_BPE,
    piece_bpe: str = PIECE_BPE,
    most_pairs: int = MOST_PAIRS,
) -> DataFrame:
    """All columns, then `n_a`, `n_b`, `n_groups`, `n_links`, `n_best`, `count_sum` and `groups`.

    A encodes a space and the text, B the text, in front of which it puts the space itself; strings of special tokens are
    plain text. Where a token of A and one of B end at the same byte, a group ends. Two tokens are linked if their bytes
    overlap; a pair's count is the number of documents that link it. `n_best` counts the links whose count is the highest
    of their A id, `count_sum` adds up the counts of all links, `groups` lists the ids: `a1,a2|b1;a3|b2,b3`.

    * NULL or empty text, or text whose bytes a tokenizer does not give back, has zeros and empty `groups`.
    * Every row is a document: repeated rows count each. Texts are encoded word by word, see `Aligner`. An input column
      named like an output gives way. No rows in, no rows out.
    * The tokenizer files are read by the driver and sent to the executors.
    """
    spark: SparkSession = docs.sparkSession
    package_on_workers(spark)
    with open(byte_bpe, encoding="utf-8") as a, open(piece_bpe, "rb") as b:
        files = a.read(), b.read()
    b_size = sentencepiece.SentencePieceProcessor(model_proto=files[1]).vocab_size()
    models = spark.sparkContext.broadcast(files)
    inner, names = shielded(docs, text)
    body = F.coalesce(F.col(names[text]), F.lit(""))
    rows = inner.withColumn("body", body)
    partial = staged(rows.select("body").mapInArrow(_pairs_of(models), "pair long, n long"), "alignment-pairs")
    distinct = staged(partial.select("pair").distinct(), "alignment-distinct")
    n = distinct.count()
    if n > most_pairs:
        keyed = rows.withColumns({"k1": F.xxhash64("body"), "k2": F.xxhash64(F.lit(1), "body")})
        result = _joined(keyed, partial, models, b_size)
    else:
        index = PairIndex(distinct.toArrow()["pair"].to_numpy())
        sent = spark.sparkContext.broadcast(index)
        pairs = spark.sparkContext.broadcast(PairCounts.of(index, summed_vectors(partial, sent), b_size))
        counted = arrow_function(_counted(models, pairs), f"struct<{_SHAPE_DDL}, n_best: long, count_sum: long>")
        result = rows.withColumn("r", counted(F.col("body")))
    outputs = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")
    return unshielded(result, docs.columns, {name: F.col(f"r.{name}") for name in outputs})
