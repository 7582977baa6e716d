"""Parts of the operators against plain versions, on generated input."""

import random

import brute
import numpy as np
import pytest
import sentencepiece
from bandwright.llm import pii, secrets, sketch
from bandwright.llm.components import components
from bandwright.llm.quality_model import fit
from bandwright.llm.sentencepiece import MODEL, encoder, read_model
from bandwright.llm.simhash import linked_fingerprints
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

PIECES = ["a@b.co", "@", ".", "+", "-", " ", "1", "12", "4111 1111 1111 1111", "255.1.2.3", "256", "(", ")", "é", "x", "İ",
          "a.b", "%", "_", "\n", "5500-0000-0000-0004", "+1 (017) 555-7713", "iban ", "://", "mailto:"]


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=14).map("".join))
def test_anchors_find_what_patterns_find(text):
    order = {kind: i for i, kind in enumerate(pii.BASE_KINDS)}
    base = sorted((order[k], i, j) for k, i, j in pii.find_spans(text) if k in order)
    assert base == [(order[k], i, j) for k, i, j in brute.pii_spans(text)]


@pytest.mark.parametrize(
    "text, kind, value",
    [
        ("see ftp://joe:pw@host.example/x now", "address", "ftp://joe:pw@host.example"),
        ("mailto:a@b.co", "address", "mailto:a@b.co"),
        ("call tel:+49-30-1234567.", "address", "tel:+49-30-1234567"),
        ("IBAN: DE89 3704 0044 0532 0130 00 ok", "account", "DE89 3704 0044 0532 0130 00"),
        ("SSN 078-05-1120", "account", "078-05-1120"),
        ("Account no. 12345678", "account", "12345678"),
    ],
)
def test_added_kinds(text, kind, value):
    assert (kind, value) in [(k, text[i:j]) for k, i, j in pii.find_spans(text)]


@pytest.mark.parametrize("text", ["https://example.com/a?b=1", "iban DE00 1234", "on account of 12 people", "the account"])
def test_nothing_added_to_plain_text(text):
    assert list(pii.find_spans(text)) == []


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from("abe thn.\n  éü漢🙂1▂<>s"), max_size=120))
def test_encoder_equals_library(text):
    mine = encoder(read_model())
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    assert list(mine.encode(text)) == library.encode(text)
    assert mine.decode(mine.encode(text)) == text


@pytest.mark.parametrize("text", ["a" * 3000, " " * 1000, "ab" * 1500, "the" * 1000, "x\n" * 500])
def test_streaming_without_word_ends(text):
    mine = encoder(read_model())
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    marked = "▁" + text.replace(" ", "▁")
    assert list(mine.stream(iter(marked))) == library.encode(text)


def test_stream_keeps_a_short_window():
    """Without a single word end, ids still follow closely behind the characters that were read."""
    mine, rng, read, written, behind = encoder(read_model()), random.Random(2), 0, 0, 0

    def characters():
        nonlocal read
        for _ in range(20_000):
            read += 1
            yield rng.choice("thequickbrown")

    for number in mine.stream(characters()):
        behind = max(behind, read - written)
        written += len(mine.vocabulary.pieces[number])
    assert written == read == 20_000 and behind < 20 * mine.vocabulary.longest


def test_secret_patterns(spark):
    rng = random.Random(7)
    parts = ["password", "Token", "api_key", ":", "=", " ", '"', "'", "abc", "0123456789abcdef" * 2, "AKIA", "ABCDEFGHIJKL", "é",
             "secret:token:", "x" * 9, "\n"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(12))) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in secrets.find_secrets(df).collect():
        assert [tuple(s) for s in row.secrets if s.kind != "random"] == brute.secret_spans(row.text)


def test_random_strings_are_told_from_words(spark):
    rng = random.Random(11)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    words = "configuration transactional responsibility containerized applications interconnected serialization".split()
    plain = [" ".join(rng.choices(words, k=30)) for _ in range(300)]
    samples = secrets.labelled_samples(spark.createDataFrame(list(enumerate(plain)), "doc_id long, text string"))
    models = secrets.fit_models(samples)
    tokens = [("".join(rng.choices(letters, k=24)), 1) for _ in range(100)]
    tokens += [("".join(w.capitalize() for w in rng.choices(words, k=3)) + "2", 0) for _ in range(100)]
    df = spark.createDataFrame(tokens, "token string, label int")
    hits = df.select("label", (models.score(F.col("token")) >= secrets.THRESHOLD).alias("hit")).collect()
    assert sum(r.hit for r in hits if r.label == 1) >= 95
    assert sum(r.hit for r in hits if r.label == 0) <= 2


def _components(edges):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {x: root(x) for edge in edges for x in edge}


@pytest.mark.parametrize("kind", ["path", "star", "random", "none", "loops"])
def test_components(spark, kind):
    rng = random.Random(3)
    edges = {
        "path": [(i, i + 1) for i in range(60)],
        "star": [(0, i) for i in range(1, 200)],
        "random": [(rng.randrange(150), rng.randrange(150)) for _ in range(90)],
        "none": [],
        "loops": [(1, 1), (2, 2)],
    }[kind]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == _components([e for e in edges if e[0] != e[1]])


@pytest.mark.parametrize("bits", [0, 3, 4, 5])
def test_links_within_bits(spark, bits):
    rng = random.Random(bits)
    prints = set()
    for _ in range(12):  # clusters around centres, members at growing distance
        centre = rng.getrandbits(64)
        for _ in range(25):
            flip = sum(1 << b for b in rng.sample(range(64), rng.randrange(7)))
            prints.add(centre ^ flip)
    prints = sorted(prints)
    edges = [(a, b) for i, a in enumerate(prints) for b in prints[:i] if (a ^ b).bit_count() <= bits]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    df = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    got = {r.node: r.label for r in linked_fingerprints(df, bits).collect()}
    want = _components([(signed(a), signed(b)) for a, b in edges])
    groups = lambda labels: sorted(sorted(x for x in labels if labels[x] == y) for y in set(labels.values()))
    assert groups(got) == groups(want)


def test_sketches_merge_and_estimate_containment(spark):
    rng = random.Random(5)
    words = [f"w{rng.randrange(10**6)}" for _ in range(8000)]
    whole, part = " ".join(words), " ".join(words[1000:1600])
    rows = spark.createDataFrame([(whole, part, " ".join(words[:4000]), " ".join(words[4000:]))], "w string, p string, a string, b string")
    for name in "wpab":
        rows = sketch.with_sketch(rows, name, f"s{name}")
    row = rows.select(
        sketch.containment(F.col("sp"), F.col("sw")).alias("inside"),
        sketch.containment(F.col("sw"), F.col("sp")).alias("outside"),
        F.size(F.array_except("sw", sketch.merged(F.col("sa"), F.col("sb")))).alias("missing"),
        F.size("sw").alias("n"),
    ).first()
    assert row.inside == 1.0 and abs(row.outside - 596 / 7996) < 0.03
    assert row.missing <= 4 and abs(row.n / 7996 - 1 / 4) < 0.03


def test_model_learns_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.random((4000, 15))
    y = ((x[:, 3] > 0.5) ^ (x[:, 7] > 0.5)).astype(float)
    model = fit(x[:3000], y[:3000])
    assert (3, 7) in model.pairs
    assert ((model.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.95
