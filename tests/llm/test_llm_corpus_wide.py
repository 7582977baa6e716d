"""Centroid clusters, repeats across documents and aligned tokenizers against plain versions."""

import random

import brute
import numpy as np
import pytest
import sentencepiece
from bandwright.llm import alignment, queries, repeats
from bandwright.llm.alignment import PairIndex, align_tokenizers, byte_values
from bandwright.llm.clusters import Centroids, centroid_clusters, largest_component
from bandwright.llm.repeats import deep_nodes, remove_repeats
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

# Clusters


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 9), st.integers(1, 3), st.integers(0, 10**6))
def test_orchard_search_is_exact(k, dims, seed):
    draw = np.random.default_rng(seed)
    places = draw.integers(-4, 5, (k, dims))
    vectors = draw.integers(-6, 7, (50, dims))
    best, distance = Centroids.of(places.tolist()).nearest(vectors)
    all_distances = ((vectors[:, None] - places[None]) ** 2).sum(axis=2)
    assert best.tolist() == all_distances.argmin(axis=1).tolist()
    assert distance.tolist() == all_distances.min(axis=1).tolist()


def test_clusters_of_the_table(spark, sf):
    rows = queries.op11_centroid_clusters(spark, sf).collect()
    table = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    found, inertia, centroids = brute.clusters([(r.vec_id, r.embedding) for r in table], 40, 5, 64)
    digests = [brute.sha256(",".join(map(str, c))) for c in centroids]
    assert sorted((r.vec_id, r.cluster, r.distance, r.cluster_inertia) for r in rows) == sorted(found)
    assert {r.inertia for r in rows} == {inertia}
    assert all(r.centroid_sha256 == digests[r.cluster] for r in rows)


def test_clusters_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    data = [(1, [0.5, -0.001]), (1, [0.5, -0.001]), (None, [3.0, 4.0]), (2, [1.0]), (3, None), (4, [None, 1.0]),
            (5, [nan, 1.0]), (6, [inf, 1.0]), (7, []), (8, [0.25, 0.0]), (9, [0.5, 0.25]), (None, [3.0, -4.0])]
    rows = spark.createDataFrame([(*d, "x") for d in data], "vec_id long, embedding array<double>, cluster string")
    for k in (1, 3, 40):
        out, places = centroid_clusters(rows, k=k, rounds=2, dims=2)
        assert out.columns == ["vec_id", "embedding", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
        found, inertia, centroids = brute.clusters(data, k, 2, 2)
        key = lambda row: tuple((x is None, x or 0) for x in row)
        assert sorted(((r.vec_id, r.cluster, r.distance, r.cluster_inertia) for r in out.collect()), key=key) == sorted(found, key=key)
        assert places == centroids
    empty, places = centroid_clusters(rows.where("vec_id = 7"), dims=2)
    assert (empty.count(), places) == (0, []) and dict(empty.dtypes)["distance"] == "bigint"
    far = spark.createDataFrame([(1, [float(largest_component(2)), 0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="would not fit"):
        centroid_clusters(far, dims=2)[0].collect()


# Repeats


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), min_size=1, max_size=14), min_size=1, max_size=6), st.integers(1, 7))
def test_deep_nodes_are_repeats(stretches, depth):
    tokens = np.array([t for s in stretches for t in s])
    ends = np.cumsum([len(s) for s in stretches])
    places, nodes = deep_nodes(tokens, np.repeat(ends, [len(s) for s in stretches]), depth)
    wanted = {}
    for s, end in zip(stretches, ends.tolist()):
        for at in range(len(s) - depth + 1):
            wanted.setdefault(tuple(s[at : at + depth]), set()).add(end - len(s) + at)
    found = {}
    for place, node in zip(places.tolist(), nodes.tolist()):
        found.setdefault(node, set()).add(place)
    assert sorted(map(sorted, found.values())) == sorted(sorted(p) for p in wanted.values() if len(p) > 1)


def _kept(rows):
    key = lambda row: tuple((x is None, x if x is not None else 0) for x in row)
    return sorted(rows, key=key)


def _same_as_brute(docs, frame, window):
    out = remove_repeats(frame, window=window)
    rows = [(r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in out.collect()]
    assert _kept(rows) == _kept(brute.without_repeats(docs, window))


def test_repeats_of_the_table(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    rows = queries.op12_substring_dedup(spark, sf).collect()
    wanted = [(i, n, gone, brute.sha256(kept)) for i, n, gone, kept in brute.without_repeats(docs, 50)]
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in rows) == sorted(wanted)
    assert any(0 < n < m for _, m, n, _ in wanted)


@pytest.mark.parametrize("most, broadcast", [(2048, 1 << 24), (2, 1 << 24), (3, 0)])
def test_repeats_of_copies_passages_and_odd_rows(spark, monkeypatch, most, broadcast):
    monkeypatch.setattr(repeats, "MOST", most)
    monkeypatch.setattr(repeats, "BROADCAST_BYTES", broadcast)
    draw = random.Random(5)
    word = lambda: draw.choice("ab") if draw.random() < 0.3 else f"w{draw.randrange(10**6)}é"
    passages = [[word() for _ in range(n)] for n in (10, 14, 30)]
    docs = []
    for i in range(60):
        w = [word() for _ in range(draw.randrange(40))]
        for _ in range(draw.randrange(3)):
            p, at = draw.choice(passages), draw.randrange(len(w) + 1)
            w[at:at] = p[draw.randrange(4) : len(p) - draw.randrange(4)]
        docs.append((draw.choice([i, i, i, 7, None]), draw.choice([" ", "\n", " \t"]).join(w)))
    docs += draw.sample(docs, 12) + [(1, None), (None, None), (3, ""), (4, " \n"), (5, "a " * 3000), (2, "a " * 1500), (90, "a " * 3000)]
    docs += [(i + 100, docs[5][1]) for i in range(9)] + [(None, docs[6][1]), (0, docs[6][1] + " a b")]
    frame = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, kept_text string, a int")
    _same_as_brute(docs, frame, 10)
    _same_as_brute([(None if i is None else f"d{i:03}", t) for i, t in docs][:40],
                   frame.limit(40).withColumn("doc_id", F.concat(F.lit("d"), F.lpad(F.col("doc_id").cast("string"), 3, "0"))), 9) if most == 2048 else None


def _common_passages(n, ids, seed=3):
    """Documents with one passage in other words each, near copies of one text, and lines said over and over."""
    draw = random.Random(seed)
    word = lambda: draw.choice("ab") if draw.random() < 0.3 else f"w{draw.randrange(10**6)}"
    some = lambda k: [word() for _ in range(k)]
    passage, base, line = some(70), some(260), some(5)
    docs = []
    for i in range(n):
        near = list(base)
        near[draw.randrange(len(near))] = word()
        mixed = some(draw.randrange(60)) + passage[draw.randrange(9) :] + some(draw.randrange(60))
        for w in (mixed, near, some(draw.randrange(4)) + line * draw.randrange(9, 25) + ["a"] * draw.randrange(40, 130)):
            docs.append((ids(draw, len(docs)), " ".join(w)))
    draw.shuffle(docs)
    return docs


@pytest.mark.parametrize("window, most, broadcast", [(50, 2, 1 << 24), (50, 5, 0), (24, 3, 1 << 24), (5, 2, 0)])
def test_repeats_of_frequent_passages(spark, monkeypatch, window, most, broadcast):
    monkeypatch.setattr(repeats, "MOST", most)
    monkeypatch.setattr(repeats, "BROADCAST_BYTES", broadcast)
    docs = _common_passages(14, lambda draw, i: draw.choice([i, i, i, 7, None]))
    _same_as_brute(docs, spark.createDataFrame(docs, "doc_id long, text string"), window)


def test_frequent_passages_take_no_row_for_each_word(spark, monkeypatch):
    """Near copies under frequent anchors: spans are of stretches, and no table on the way has a row per window."""
    monkeypatch.setattr(repeats, "MOST", 4)
    made, keep = {}, repeats.staged
    def counting(df, name):
        out = keep(df, name)
        made[name] = max(made.get(name, 0), out.count())
        return out
    monkeypatch.setattr(repeats, "staged", counting)
    docs = [(i, text) for i, (_, text) in enumerate(_common_passages(40, lambda draw, i: i)) if len(text.split()) == 260]
    windows = len(docs) * (260 - 49)
    known = repeats.repeated_words(spark.createDataFrame(docs, "doc_id long, text string"), window=50)
    assert known.agg(F.sum(F.size("spans"))).first()[0] < windows / 8
    assert max(made.values()) < windows / 8, made


@pytest.mark.parametrize("window, cell", [(w, c) for w in (3, 8, 9, 12, 24, 50) for c in repeats.cells(w)])
def test_pieces_cover_windows_and_equal_windows_share_a_prefix(window, cell):
    draw, prefixes = random.Random(window), {}
    passage = [draw.choice("abc") for _ in range(2 * window)]
    for _ in range(30):
        words = [draw.choice("abc").encode() for _ in range(draw.randrange(9))] + [w.encode() for w in passage]
        at = 0
        for prefix, start, end, body in repeats._pieces(words, window, cell):
            assert (start, body) == (at, b" ".join(words[start:end])) and end - start >= window
            at = end - window + 1
            for i in range(start, at):
                assert prefixes.setdefault(tuple(words[i : i + window]), prefix) == prefix
        assert at == len(words) - window + 1


def test_repeats_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    out = remove_repeats(empty)
    assert (out.columns, out.count()) == (["doc_id", "text", "n_words", "n_removed", "kept_text"], 0)
    with pytest.raises(ValueError):
        remove_repeats(empty, window=0)


# Tokenizers


@pytest.fixture(scope="module")
def sides():
    a = Tokenizer.from_file(alignment.BYTE_BPE)
    a.encode_special_tokens = True
    names, values = {i: t for t, i in a.get_vocab().items()}, byte_values()
    b = sentencepiece.SentencePieceProcessor(model_file=alignment.PIECE_BPE)

    def piece(i):
        text = b.id_to_piece(i)
        return bytes([int(text[1:-1], 16)]) if b.is_byte(i) else text.replace("▁", " ").encode()

    return (
        lambda text: [(i, bytes(values[c] for c in names[i])) for i in a.encode(text, add_special_tokens=False).ids],
        lambda text: [(i, piece(i)) for i in b.encode(text)],
    )


ODD = ["", None, " ", "  a", "a ", "▁", "a▁b", "<|endoftext|> x", "<s> <0x41></s>", "naïve 漢字 🙂 é", "x\n\n\ty\r\n",
       "it's we'll  2024", "\x00\x01", "a" * 300, "İı ſ", "  　", "the cat the cat"]


def test_alignment_of_odd_texts(spark, sides):
    texts = ODD + ODD[5:9] + ["the cat sat"] * 3
    frame = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, groups int").repartition(3)
    wanted = brute.alignment(texts, *sides)
    for most in (10**6, 0):  # by hash, and joined
        rows = align_tokenizers(frame, most_pairs=most).orderBy("doc_id").collect()
        found = [(r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups) for r in rows]
        assert found == wanted


def test_alignment_of_the_table(spark, sf, sides):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()]
    wanted = brute.alignment([t for _, t in docs], *sides)
    rows = sorted(queries.op13_tokenizer_alignment(spark, sf).collect())
    assert [tuple(r)[:7] for r in rows] == [(i, *w[:6]) for (i, _), w in zip(docs, wanted)]
    for r, w in zip(rows, wanted):
        if w[6] is not None:
            assert r.groups_sha256 == (brute.sha256(w[6]) if w[6] else "")


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["the", " cat", "  ", " 漢", "\n", " don't", "5", " é", "aa", "\t ", "\r\n", "▁", "\u00a0", "\u3000 x", "\x1c", " "]),
                         max_size=12).map("".join), max_size=5))
def test_words_give_what_texts_give(texts):
    known = alignment.aligner(open(alignment.BYTE_BPE, encoding="utf-8").read(), open(alignment.PIECE_BPE, "rb").read())
    block = alignment.Block.of(known, texts)
    for i, (text, groups) in enumerate(zip(texts, block.groups(known))):
        a = known.a.encode(" " + text, add_special_tokens=False).ids if text else []
        b = known.b.encode(text)
        same = b"".join(known.b_bytes[j] for j in b) == (" " + text).encode()
        assert bool(block.whole[i]) == bool(text and same)
        if block.whole[i]:
            sides = [[int(x) for g in groups.split(";") for x in g.split("|")[side].split(",")] for side in (0, 1)]
            assert sides == [a, b] and block.sizes[:2, i].tolist() == [len(a), len(b)]


def test_forgotten_words_are_learned_again(spark, sf, monkeypatch):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(60)
    texts = [r.text or "" for r in docs.select("text").collect()]
    known = alignment.Aligner(open(alignment.BYTE_BPE, encoding="utf-8").read(), open(alignment.PIECE_BPE, "rb").read())
    whole = alignment.Block.of(known, texts)
    monkeypatch.setattr(alignment, "CACHED", 300)
    for i, text in enumerate(texts):
        one = alignment.Block.of(known, [text])
        assert one.sizes[:, 0].tolist() == whole.sizes[:, i].tolist()
    assert len(known.numbers) < 6000


def test_alignment_of_nothing(spark):
    for most in (10, 0):
        out = align_tokenizers(spark.createDataFrame([], "doc_id long, text string"), most_pairs=most)
        assert out.count() == 0 and out.columns[-1] == "groups"


@pytest.mark.parametrize("n", [0, 1, 2, 63, 1000, 60_000])
def test_perfect_hash(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 1 << 48, n))
    index = PairIndex(keys)
    places = index.places(keys)
    assert sorted(places.tolist()) == list(range(len(keys)))
    others = np.setdiff1d(np.arange(1 << 48, (1 << 48) + 500), keys)
    assert (index.places(others) == -1).all()


def test_vectors_are_summed_as_a_tree(spark, monkeypatch):
    monkeypatch.setattr(alignment, "SLICE", 8)
    monkeypatch.setattr(alignment, "FAN", 2)
    keys = np.arange(100, 141)
    index = spark.sparkContext.broadcast(PairIndex(keys))
    partial = spark.range(0, 400, 1, 7).select((F.col("id") % 41 + 100).alias("pair"), (F.col("id") % 5).alias("n"))
    vector = alignment.summed_vectors(partial, index)
    wanted = {r.pair: r.n for r in partial.groupBy("pair").agg(F.sum("n").alias("n")).collect()}
    assert {int(k): int(v) for k, v in zip(index.value.keys, vector)} == wanted
