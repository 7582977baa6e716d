"""The Viterbi pass over many runs at once, against the library, the pass over one run and plain merging."""

import random

import numpy as np
import pytest
from sentencepiece import SentencePieceProcessor

from bandwright.llm import sentencepiece


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=sentencepiece.MODEL)


@pytest.fixture
def encoder():
    return sentencepiece.Encoder(sentencepiece.read_model())


def texts_of(alphabet: str, n: int, longest: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choices(alphabet, k=rng.randint(0, longest))) for _ in range(n)]


def test_new_short_runs_are_not_searched_one_by_one(encoder, library, monkeypatch):
    monkeypatch.setattr(sentencepiece.Encoder, "_reach", None)
    monkeypatch.setattr(sentencepiece.Vocabulary, "agree", None)
    texts = texts_of("etaoin shrdlu, ", 400, 200, 1) + texts_of("aé漢\U0001f642ß٣ \n.", 200, 40, 2) + [""]
    assert encoder.encode_all(texts) == [library.encode(text) for text in texts]
    assert encoder.encode_all(texts[::-1]) == [library.encode(text) for text in texts[::-1]]
    assert encoder.encode_all([]) == []


def test_runs_of_all_lengths_and_marks(encoder, library):
    texts = ["a" * 47, "a" * 48, "a" * 500, " " * 60, "x  y", "▁", "▁a ▁▁b", " a", "a ", "the" * 16, "\U0001f642" * 60, "x\n" * 70]
    texts.append(" ".join(texts) * (sentencepiece.BLOCK // 500))
    assert len(texts[-1]) > sentencepiece.BLOCK
    assert encoder.encode_all(texts) == [library.encode(text) for text in texts]


def test_pairs_agree_as_by_merging(encoder):
    levels, vocabulary = encoder.levels, encoder.vocabulary
    assert levels.ordered
    rng, letters = random.Random(3), [i for piece, i in vocabulary.ids.items() if piece.isascii() and len(piece) < 6]
    left, right = (np.array(rng.choices(letters, k=8000)) for _ in range(2))
    derived = [vocabulary.merged(vocabulary.pieces[i]) == [vocabulary.pieces[i]] for i in range(levels.size)]
    both = np.array([derived[i] and derived[j] for i, j in zip(left, right)])
    left, right = left[both], right[both]
    wanted = [vocabulary.agree(int(i), int(j)) for i, j in zip(left, right)]
    assert 100 < sum(wanted) < len(wanted) - 100
    assert levels._agree(left, right).tolist() == wanted
    levels.ordered = False
    assert levels._agree(left[:500], right[:500]).tolist() == wanted[:500]


def test_pairs_that_share_a_place_are_told_apart(encoder, library, monkeypatch):
    monkeypatch.setattr(sentencepiece, "PLACE_BITS", 3)
    levels = encoder.levels
    levels.pairs, levels.values = np.full(8, -1), np.zeros(8, bool)
    texts = texts_of("etaoin shrdlu", 200, 200, 4)
    assert encoder.encode_all(texts) == [library.encode(text) for text in texts]


def test_runs_are_forgotten_when_too_many_are_known(encoder, library, monkeypatch):
    monkeypatch.setattr(sentencepiece, "CACHED_WORDS", 50)
    for text in texts_of("etaoin shrdlu", 20, 400, 5):
        assert encoder.encode_all([text, text]) == [library.encode(text)] * 2
    assert len(encoder.numbers) < 200
    monkeypatch.setattr(sentencepiece, "CACHED_WORDS", 10**6)
    monkeypatch.setattr(sentencepiece, "CACHED_CHARACTERS", 50)
    for text in texts_of("etaoin", 20, 400, 6):
        assert encoder.encode_all([text]) == [library.encode(text)]
    assert len(encoder.numbers) < 4
