"""SentencePiece encoding and decoding by a streaming Viterbi pass.

The model is of the BPE kind, whose pieces carry merge ranks and no probabilities, so the best path is the one that
merging would give. A sequence of pieces is that one exactly if each two neighbours stay two pieces when merged by
themselves. That makes merging a shortest-path problem: every boundary of the text has one piece that ends there and
agrees with the piece before it, found by looking back no further than the longest piece. Ids are committed as soon
as the backpointer paths of all boundaries that a later piece can reach run through one boundary.

New runs of a block of texts go through that pass together, in arrays: first all boundaries after one character, then all
after two, and so on. Runs that begin alike share the boundaries of what they begin with.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence
from itertools import islice

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame, functions as F

from .common import arrow_function, blocks_of, shielded, unshielded

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Runs kept with their ids in each Python worker, their characters, the longest run that goes with others, and the runs
#: kept of texts longer than a block.
CACHED_WORDS, CACHED_CHARACTERS = 800_000, 1 << 24
CACHED_LENGTH = 48
CACHED_OF_LONG = 100_000
#: Pairs of pieces of which a worker remembers whether they agree, and the characters read at once.
MOST_AGREED = 1_000_000
BLOCK = 1 << 16
#: Characters of texts whose new runs are encoded together.
TOGETHER = 1 << 21
#: Bits of the place at which the pass over many runs remembers whether a pair agrees.
PLACE_BITS = 20
#: What ends at a boundary, where it is no piece: a character outside the vocabulary or the start.
OTHER = -1
_LETTER = re.compile(r"[^\W\d_]")


class Vocabulary:
    """Pieces of a BPE model with byte fallback."""

    def __init__(self, model: bytes):
        loaded = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = loaded.vocab_size()
        self.pieces = [loaded.id_to_piece(i) for i in range(size)]
        special = [loaded.is_control(i) or loaded.is_unknown(i) or loaded.is_unused(i) for i in range(size)]
        self.byte_ids = [loaded.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        is_byte = set(self.byte_ids)
        self.ids = {p: i for i, p in enumerate(self.pieces) if not special[i] and i not in is_byte}
        self.rank_of = {piece: -loaded.get_score(i) for piece, i in self.ids.items()}
        self.longest = max(map(len, self.ids))
        # A tree of all pieces, read from their ends: under each character the id of the piece that starts with it, if
        # one does, and what may precede.
        self.tree: dict[str, list] = {}
        for piece, number in self.ids.items():
            node = self.tree
            for character in piece[:0:-1]:
                node = node.setdefault(character, [-1, {}])[1]
            node.setdefault(piece[0], [-1, {}])[0] = number
        self.runs, self.plain_runs = self._runs(SPACE), self._runs(" ")
        self.bytes_of = [b"" if s else p.replace(SPACE, " ").encode() for p, s in zip(self.pieces, special)]
        for value, i in enumerate(self.byte_ids):
            self.bytes_of[i] = bytes([value])
        #: Which pairs of pieces agree, as far as asked; forgotten when too many are known.
        self.agreed: defaultdict[int, dict[int, bool]] = defaultdict(dict)
        self.n_agreed = 0

    def _runs(self, mark: str) -> re.Pattern | None:
        """The pattern that cuts a text where no piece can reach over: before a space mark that follows another
        character, and between letters and all else. None if some piece has the mark elsewhere than in front.

        Letters that some piece holds beside another kind of character count as that kind.
        """
        if any(SPACE in piece.lstrip(SPACE) for piece in self.ids):
            return None
        mixed: set[str] = set()
        pairs = {pair for piece in self.ids for pair in zip(piece, piece[1:]) if SPACE not in pair}
        while True:
            odd = set()
            for pair in pairs:
                letters = [c for c in pair if _LETTER.match(c) and c not in mixed]
                odd.update(letters if len(letters) == 1 else ())
            if not odd:
                break
            mixed |= odd
        out = "".join(map(re.escape, sorted(mixed)))
        return re.compile(rf"{mark}*(?:[^\W\d_{out}]+|(?:[^\w{mark}]|[\d_{out}])+)|{mark}+")

    def merged(self, text: str, fewest: int = 1) -> list[str]:
        """The pieces of a short text by merging neighbours, best rank first, leftmost first, down to `fewest`."""
        parts, rank = list(text), self.rank_of.get
        while True:
            if len(parts) <= fewest:
                return parts
            best, at = None, 0
            for i in range(len(parts) - 1):
                found = rank(parts[i] + parts[i + 1])
                if found is not None and (best is None or found < best):
                    best, at = found, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def agree(self, left: int, right: int) -> bool:
        """Whether piece `right` can follow `left` (OTHER: the start, or a character outside the vocabulary)."""
        two = [self.pieces[right]] if left == OTHER else [self.pieces[left], self.pieces[right]]
        if self.n_agreed >= MOST_AGREED:
            self.agreed.clear()
            self.n_agreed = 0
        known = self.agreed[left][right] = self.merged("".join(two)) == two
        self.n_agreed += 1
        return known


def _table(entries: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys and their values; the last key is above all others."""
    keys = np.array([*entries, np.iinfo(np.int64).max], np.int64)
    order = np.argsort(keys)
    return keys[order], np.array([*entries.values(), -1])[order]


class Levels:
    """The Viterbi pass over many short runs at once: boundaries of all runs after one character, after two, and so on.

    Boundaries form a tree, as runs that begin alike share theirs; the root, number 0, is the start of every run.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.size = len(vocabulary.pieces)
        # A piece that merging does not give by itself follows nothing.
        last = {piece: vocabulary.merged(piece, 2) for piece in vocabulary.ids}
        pieces = {piece: vocabulary.ids[piece] for piece, parts in last.items() if len(parts) <= 2}
        #: Characters by code point; 0 for those of no piece.
        self.number = np.zeros(0x110000, np.int32)
        characters = sorted({c for piece in pieces for c in piece})
        self.number[[ord(c) for c in characters]] = np.arange(1, len(characters) + 1)
        self.number[ord(" ")] = self.number[ord(SPACE)]
        self.width = len(characters) + 1
        # The tree of pieces, read from their ends: state and character give the next state.
        steps: dict[int, int] = {}
        ends = [-1]
        for piece, i in pieces.items():
            state = 0
            for number in self.number[[ord(c) for c in reversed(piece)]].tolist():
                state = steps.setdefault(state * self.width + number, len(ends))
                if state == len(ends):
                    ends.append(-1)
            ends[state] = i
        self.steps, self.states = _table(steps)
        self.piece = np.array(ends)
        #: Places of pairs of pieces, and whether they agree; a pair takes the place from another one.
        self.pairs, self.values = np.full(1 << PLACE_BITS, -1), np.zeros(1 << PLACE_BITS, bool)
        self._merges(pieces, last)

    def _merges(self, pieces: dict[str, int], last: dict[str, list[str]]) -> None:
        """By piece the rank of its merge (-1 of a character) and the two pieces merged, and the ranks of pairs."""
        ids, rank_of = self.vocabulary.ids, self.vocabulary.rank_of
        self.born = np.full(self.size, -1.0)
        self.left, self.right = np.zeros(self.size, np.int64), np.zeros(self.size, np.int64)
        #: Whether every piece is merged after its parts, so that ranks tell the order of all merges.
        self.ordered = all(c in ids for piece in ids for c in piece)
        if not self.ordered:
            return
        for piece, i in pieces.items():
            if len(piece) > 1:
                self.born[i] = rank_of[piece]
                self.left[i], self.right[i] = (ids[part] for part in last[piece])
        merged = np.array([i for piece, i in pieces.items() if len(piece) > 1], np.int64)
        parts = np.maximum(self.born[self.left[merged]], self.born[self.right[merged]])
        self.ordered = bool(np.all(parts <= self.born[merged])) and min(rank_of.values()) >= 0
        pairs = {
            ids[piece[:k]] * self.size + ids[piece[k:]]: i
            for piece, i in ids.items()
            for k in range(1, len(piece))
            if piece[:k] in ids and piece[k:] in ids
        }
        self.joined, into = _table(pairs)
        ranks = np.full(self.size, np.inf)
        ranks[list(ids.values())] = [rank_of[piece] for piece in ids]
        self.joined_rank = np.where(into >= 0, ranks[into], np.inf)

    def _agree(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether piece `right` can follow piece `left`: whether no merge over the cut comes before others take what
        stands there. Merges are undone from the last one on, and each two pieces that met at the cut are looked up."""
        if not self.ordered:
            return np.array([self.vocabulary.agree(i, j) for i, j in zip(left.tolist(), right.tolist())], bool)
        agreed, at = np.ones(len(left), bool), np.arange(len(left))
        left_end = right_end = np.full(len(left), np.inf)
        while len(at):
            key = left * self.size + right
            place = np.searchsorted(self.joined, key)
            rank = np.where(self.joined[place] == key, self.joined_rank[place], np.inf)
            # Of equal ranks the leftmost is merged first.
            crossed = (rank < left_end) & (rank <= right_end)
            agreed[at[crossed]] = False
            left_born, right_born = self.born[left], self.born[right]
            on = ~crossed & ((left_born >= 0) | (right_born >= 0))
            at, left, right, left_end, right_end, left_born, right_born = (
                x[on] for x in (at, left, right, left_end, right_end, left_born, right_born)
            )
            back = left_born > right_born
            left_end, right_end = np.where(back, left_born, left_end), np.where(back, right_end, right_born)
            left, right = np.where(back, self.right[left], left), np.where(back, right, self.left[right])
        return agreed

    def _places(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - PLACE_BITS)).astype(np.int64)

    def agree(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether piece `right` can follow `left` (OTHER: the start, or a character outside the vocabulary)."""
        keys = (left + 1) * self.size + right
        places = self._places(keys)
        agreed, asked = self.values[places], self.pairs[places] != keys
        if asked.any():
            new, at = np.unique(keys[asked], return_inverse=True)
            left, right = new // self.size - 1, new % self.size
            found, pair = np.ones(len(new), bool), left != OTHER
            found[pair] = self._agree(left[pair], right[pair])
            agreed[asked] = found[at]
            # One pair by place.
            places, once = np.unique(self._places(new), return_index=True)
            self.pairs[places], self.values[places] = new[once], found[once]
        return agreed

    def _reach(self, first: int, last: int) -> None:
        """For each boundary from `first` up to `last`, find the piece that ends there and agrees with the one before."""
        at = np.arange(first, last)
        node, state = at, np.zeros(len(at), np.int64)
        while len(at):
            key = state * self.width + self.character[node]
            place = np.searchsorted(self.steps, key)
            on = self.steps[place] == key
            at, state, node = at[on], self.states[place[on]], self.before[node[on]]
            piece = self.piece[state]
            ending = np.flatnonzero(piece >= 0)
            fits = ending[self.agree(self.ends[node[ending]], piece[ending])]
            self.ends[at[fits]], self.starts[at[fits]] = piece[fits], node[fits]
            on = node > 0
            on[fits] = False
            at, state, node = at[on], state[on], node[on]

    def encode(self, runs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the runs one after the other, and how many each has. The runs are sorted and none is empty."""
        length = np.fromiter(map(len, runs), np.int64, len(runs))
        characters = self.number[np.frombuffer("".join(runs).encode("utf-32-le"), np.uint32)]
        start = np.cumsum(length) - length
        size = len(characters) + 1
        #: By boundary: the one before it, the character between, the piece that ends there, where that starts.
        self.before, self.character = np.zeros(size, np.int64), np.zeros(size, np.int64)
        self.ends, self.starts = np.full(size, OTHER), np.zeros(size, np.int64)
        last, rows, done = np.zeros(len(runs), np.int64), np.arange(len(runs)), 1
        for depth in range(int(length.max()) if len(runs) else 0):
            rows = rows[length[rows] > depth]
            before, character = last[rows], characters[start[rows] + depth]
            new = np.r_[True, (before[1:] != before[:-1]) | (character[1:] != character[:-1])]
            last[rows] = done + np.cumsum(new) - 1
            first, done = done, done + int(new.sum())
            self.before[first:done] = self.starts[first:done] = before[new]
            self.character[first:done] = character[new]
            self._reach(first, done)
        return self._paths(runs, last)

    def _paths(self, runs: list[str], last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, odd = np.zeros(len(runs), np.int64), np.zeros(len(runs), bool)
        rows, at, steps = np.arange(len(runs)), last, []
        while len(rows):
            piece = self.ends[at]
            odd[rows[piece == OTHER]] = True
            n[rows] += 1
            steps.append((rows, piece))
            at = self.starts[at]
            rows, at = rows[at > 0], at[at > 0]
        bytewise = {row: self._path(runs[row], int(last[row])) for row in np.flatnonzero(odd).tolist()}
        for row, path in bytewise.items():
            n[row] = len(path)
        ends = np.cumsum(n)
        ids = np.zeros(int(ends[-1]) if len(ends) else 0, np.int32)
        for back, (rows, piece) in enumerate(steps):
            plain = ~odd[rows]
            ids[ends[rows[plain]] - 1 - back] = piece[plain]
        for row, path in bytewise.items():
            ids[ends[row] - len(path) : ends[row]] = path
        return ids, n

    def _path(self, run: str, at: int) -> list[int]:
        """Ids of a run with characters outside the vocabulary, which become bytes."""
        path, length = [], len(run)
        while at > 0:
            piece = int(self.ends[at])
            if piece == OTHER:
                path += [self.vocabulary.byte_ids[b] for b in reversed(run[length - 1].encode())]
                length -= 1
            else:
                path.append(piece)
                length -= len(self.vocabulary.pieces[piece])
            at = int(self.starts[at])
        return path[::-1]


class _Window:
    """The Viterbi pass over one run of characters, given piecemeal: boundaries, the piece that ends at each, and where it
    starts. What is settled is committed and forgotten."""

    def __init__(self, encoder: Encoder):
        self.encoder, self.reach = encoder, encoder.vocabulary.longest
        self._clear()

    def _clear(self) -> None:
        self.text, self.ends, self.starts = "", [OTHER], [0]
        self.limit, self.fresh = 8 * self.reach, True

    def _read(self) -> None:
        done, length = len(self.ends) - 1, len(self.text)
        self.ends += [OTHER] * (length - done)
        self.starts += range(done, length)
        self.encoder._reach(self.text, self.ends, self.starts, done, length)

    def feed(self, characters: str) -> list[int]:
        """Take characters in; return the ids that are certain by now."""
        self.text += characters
        if len(self.text) < self.limit:
            return []
        self._read()
        # A later piece starts at one of the last boundaries.
        ends, starts = self.ends, self.starts
        cut = self._common(set(range(len(self.text) - self.reach, len(ends))))
        path = self.encoder._path(self.text, ends, starts, cut)
        self.fresh = False
        self.text, self.ends, self.starts = self.text[cut:], ends[cut:], [max(0, k - cut) for k in starts[cut:]]
        self.limit = max(8 * self.reach, 2 * len(self.text))
        return path

    def finish(self) -> list[int]:
        """The rest of the ids, at the end of the run; the window is then empty."""
        self._read()
        path = self.encoder._path(self.text, self.ends, self.starts, len(self.text))
        self._clear()
        return path

    def _common(self, alive: set[int]) -> int:
        """The last boundary on the paths of all boundaries in `alive`."""
        while len(alive) > 1:
            last = max(alive)
            alive.remove(last)
            alive.add(self.starts[last])
        return alive.pop()


class Encoder:
    def __init__(self, model: bytes):
        self.vocabulary = Vocabulary(model)
        # Two generations: when the newer one is full it replaces the older one.
        self._words: dict[str, tuple[int, ...]] = {}
        self._older: dict[str, tuple[int, ...]] = {}
        self.levels = Levels(self.vocabulary)
        self._forget()

    def _forget(self) -> None:
        #: Runs of texts shorter than a block by number, and their characters. A run not known yet gets the next number.
        self.numbers: defaultdict[str, int] = defaultdict()
        self.numbers.default_factory = self.numbers.__len__
        self.n_characters = 0
        #: Ids of runs one after the other, and by number where a run's ids start and how many they are.
        self.ids, self.first, self.n = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _reach(self, window: str, ends: list[int], starts: list[int], first: int, last: int) -> None:
        """For each boundary in (first, last], find the piece that ends there and agrees with the one before it.

        Of all pieces that end at a boundary, one agrees with what comes before: a text has one encoding. Short pieces are
        tried first. `ends` says OTHER until a piece is found: outside the vocabulary there are bytes, whatever is beside.
        """
        vocabulary = self.vocabulary
        tree, agreed, agree = vocabulary.tree, vocabulary.agreed, vocabulary.agree
        for end in range(first + 1, last + 1):
            node = tree
            for start in range(end - 1, -1, -1):
                found = node.get(window[start])
                if found is None:
                    break
                piece, node = found
                if piece >= 0:
                    known = agreed[ends[start]].get(piece)
                    if known or known is None and agree(ends[start], piece):
                        ends[end], starts[end] = piece, start
                        break

    def _path(self, text: str, ends: list[int], starts: list[int], at: int) -> list[int]:
        """Ids on the way back from a boundary to the start."""
        path = []
        while at > 0:
            if ends[at] == OTHER:
                path += [self.vocabulary.byte_ids[b] for b in reversed(text[at - 1].encode())]
            else:
                path.append(ends[at])
            at = starts[at]
        return path[::-1]

    def _committed(self, blocks: Iterable[str]) -> Iterator[list[int]]:
        """Ids of a marked text given in blocks, as far as each block settles them. Paths run through one boundary at the
        end of every run, over which no piece reaches, and now and then inside a run too long to be held; there they are
        committed. Held: the open run, or its window."""
        runs, window, tail = self.vocabulary.runs, _Window(self), ""
        for block in blocks:
            # The open run's last character tells how it goes on.
            found = [tail + block] if runs is None else runs.findall(tail + block)
            out, opened = [], found.pop() if found else ""
            if tail and found:
                out += window.feed(found.pop(0)[len(tail) :])
                out += self._ended(window)
                tail = ""
            words = self._words
            for run in found:
                ids = words.get(run)
                if ids is None:
                    ids = self._run(run)
                    words = self._words
                out += ids
            out += window.feed(opened[len(tail) :])
            yield out
            tail = block[-1:] or tail
        yield self._ended(window)

    def _ended(self, window: _Window) -> Sequence[int]:
        if window.fresh and 0 < len(window.text) <= CACHED_LENGTH:
            run = window.text
            window._clear()
            return self._run(run)
        return window.finish()

    def stream(self, blocks: Iterable[str]) -> Iterator[int]:
        """Ids of a marked text given in blocks, one by one."""
        for ids in self._committed(blocks):
            yield from ids

    def _run(self, run: str) -> tuple[int, ...]:
        """Ids of a whole run; those of short ones are remembered."""
        ids = self._words.get(run)
        if ids is not None:
            return ids
        if len(run) > CACHED_LENGTH:
            window = _Window(self)
            return (*window.feed(run), *window.finish())
        ids = self._older.get(run)
        if ids is None:
            # One window, open and closed at once.
            ends, starts = [OTHER] * (len(run) + 1), [0, *range(len(run))]
            self._reach(run, ends, starts, 0, len(run))
            ids = tuple(self._path(run, ends, starts, len(run)))
        self._remember(run, ids)
        return ids

    def _remember(self, run: str, ids: tuple[int, ...]) -> None:
        if len(self._words) >= CACHED_OF_LONG // 2:
            self._older, self._words = self._words, {}
        self._words[run] = ids

    def _learn(self) -> None:
        """Find the ids of the runs that have a number and no ids yet."""
        runs = list(islice(reversed(self.numbers), len(self.numbers) - len(self.n)))[::-1]
        self.n_characters += sum(map(len, runs))
        order = sorted((i for i, run in enumerate(runs) if len(run) <= CACHED_LENGTH), key=runs.__getitem__)
        ids, n = self.levels.encode([runs[i] for i in order])
        long = [i for i, run in enumerate(runs) if len(run) > CACHED_LENGTH]
        of_long = [np.array(self._run(runs[i].replace(" ", SPACE)), np.int32) for i in long]
        n = np.concatenate([n, np.array([len(x) for x in of_long], np.int64)])
        first, counts, order = np.zeros(len(runs), np.int64), np.zeros(len(runs), np.int64), order + long
        first[order], counts[order] = len(self.ids) + np.cumsum(n) - n, n
        self.ids = np.concatenate([self.ids, ids, *of_long])
        self.first, self.n = np.concatenate([self.first, first]), np.concatenate([self.n, counts])

    def encode_block(self, texts: list[str]) -> list[np.ndarray]:
        """All ids of each text. New runs of texts of one block are encoded together."""
        whole = self.vocabulary.plain_runs
        if whole is None:
            return [np.array(self.encode(text), np.int32) for text in texts]
        if len(self.numbers) > CACHED_WORDS or self.n_characters > CACHED_CHARACTERS:
            self._forget()
        number, parts, ends = self.numbers.__getitem__, [np.zeros(0, np.int64)], [0]
        for text in texts:
            runs = whole.findall(" " + text.replace(SPACE, " ")) if 0 < len(text) < BLOCK else []
            parts.append(np.fromiter(map(number, runs), np.int64, len(runs)))
            ends.append(ends[-1] + len(runs))
        if len(self.numbers) > len(self.n):
            self._learn()
        numbers = np.concatenate(parts)
        n = self.n[numbers]
        bounds = np.r_[0, np.cumsum(n)]
        ids = self.ids[np.repeat(self.first[numbers] - bounds[:-1], n) + np.arange(bounds[-1])]
        found = np.split(ids, bounds[ends[1:-1]])
        return [x if len(text) < BLOCK else np.array(self.encode(text), np.int32) for text, x in zip(texts, found)]

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        """All ids of each text."""
        return [ids.tolist() for ids in self.encode_block(texts)] if texts else []

    def encode(self, text: str) -> list[int]:
        """All ids of a text; empty for an empty text."""
        if not text:
            return []
        marked = SPACE + text.replace(" ", SPACE)
        out: list[int] = []
        for ids in self._committed(marked[at : at + BLOCK] for at in range(0, len(marked), BLOCK)):
            out += ids
        return out

    def decode(self, ids: Iterable[int]) -> str:
        """The text of the ids, without the space that encoding puts in front."""
        table = self.vocabulary.bytes_of
        text = b"".join([table[i] for i in ids])
        return (text[1:] if text[:1] == b" " else text).decode("utf-8", "replace")


_ENCODERS: dict[str, Encoder] = {}


def encoder(model: bytes) -> Encoder:
    """The encoder of a model, built once in each Python process."""
    name = hashlib.sha256(model).hexdigest()
    if name not in _ENCODERS:
        _ENCODERS[name] = Encoder(model)
    return _ENCODERS[name]


def read_model(path: str = MODEL) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encode(text: Column, model: bytes) -> Column:
    """Ids of each text; an empty array for NULL or empty text. The model travels with the plan."""

    def of(batch: pa.Array) -> pa.Array:
        with_model = encoder(model)
        parts, offsets = [np.zeros(0, np.int32)], [0]
        for texts in blocks_of(batch, TOGETHER):
            for ids in with_model.encode_block(texts):
                parts.append(ids)
                offsets.append(offsets[-1] + len(ids))
        flat = pa.array(np.concatenate(parts))
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat)

    return arrow_function(of, "array<int>")(F.coalesce(text, F.lit("")))


def decode(ids: Column, model: bytes) -> Column:
    """The text of each array of ids; NULL for NULL."""

    def of(batch: pa.Array) -> pa.Array:
        with_model = encoder(model)
        return pa.array(
            [with_model.decode(x.values.to_numpy().tolist()) if x.is_valid else None for x in batch], pa.string()
        )

    return arrow_function(of, "string")(ids)


def tokenize(docs: DataFrame, text: str = "text", model: bytes | None = None) -> DataFrame:
    """All rows with `ids` and `n_tokens`.

    * Ids equal those of the SentencePiece library for the same model, whatever the length of the text. Characters
      outside the vocabulary become bytes. NULL and empty texts have no ids.
    * Decoding gives the text back, but for the character U+2581, which the model takes for a space.
    * An input column named like an output gives way to it. No shuffle; each worker keeps `CACHED_WORDS` runs.
    """
    inner, names = shielded(docs, text)
    ids = encode(F.col(names[text]), read_model() if model is None else model)
    coded = inner.withColumn("ids", ids)
    return unshielded(coded, docs.columns, {"ids": F.col("ids"), "n_tokens": F.size("ids").cast("long")})
