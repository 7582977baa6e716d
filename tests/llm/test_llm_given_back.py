"""Which words both tokenizers give back, told for all new words at once."""

import numpy as np
import pytest

from bandwright.llm import alignment


@pytest.fixture
def known():
    with open(alignment.BYTE_BPE, encoding="utf-8") as a, open(alignment.PIECE_BPE, "rb") as b:
        return alignment.Aligner(a.read(), b.read())


class Lossy:
    """Takes an umlaut for its letter, and does not put texts together again."""

    def __init__(self, library):
        self.library = library

    def encode(self, text):
        return self.library.encode(text.replace("ö", "o").replace("ü", "ue"))


def test_new_words_are_compared_by_their_bytes(known):
    texts = ["the cat", "schön the cat", "naïve 漢字 \U0001f642", "", "für ", "a▁b", "the  cat\n"]
    wanted = alignment.Block.of(known, texts)
    assert wanted.whole.tolist() == [True, True, True, False, True, False, True]
    groups = wanted.groups(known)
    known.forget()
    known.b = Lossy(known.b)
    found = alignment.Block.of(known, texts)
    kept = [0, 2, 6]
    assert np.flatnonzero(found.whole).tolist() == kept
    assert found.sizes[:, kept].tolist() == wanted.sizes[:, kept].tolist()
    assert [found.groups(known)[i] for i in kept] == [groups[i] for i in kept]
    assert not found.sizes[:, 1].any() and found.groups(known)[1] == ""


def test_bytes_of_ids():
    flat, length = np.frombuffer(b"abcde", np.uint8), np.array([1, 0, 3, 1])
    at, some = np.cumsum(length) - length, np.array([3, 1, 2, 0])
    for text, same in ((b"ebcda", True), (b"ebcdb", False), (b"ebcd", False), (b"ebcdae", False)):
        assert alignment._gives(some, flat, at, length, np.frombuffer(text, np.uint8)) is same
    assert alignment._gives(some[:0], flat, at, length, flat[:0])


def test_words_of_a_block_that_failed_are_learned_with_the_next_one(known):
    library = known.b

    class Broken:
        def encode(self, text):
            raise RuntimeError

    known.b = Broken()
    with pytest.raises(RuntimeError):
        alignment.Block.of(known, ["the cat"])
    assert len(known.place) < len(known.numbers)
    known.b = library
    block = alignment.Block.of(known, ["a the cat", "", "the cat"])
    assert block.whole.tolist() == [True, False, True] and len(known.place) == len(known.numbers)
    for side, encode in ((0, lambda text: known.a.encode(" " + text, add_special_tokens=False).ids), (1, library.encode)):
        assert block.sizes[side].tolist() == [len(encode("a the cat")), 0, len(encode("the cat"))]
