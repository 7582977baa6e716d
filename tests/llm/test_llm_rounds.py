"""Work that may not be done again and again: rounds of the mixture, searches of the tokenizers."""

from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from bandwright.llm import alignment, mixing, sentencepiece


def test_mixture_has_few_rounds_where_every_document_taken_is_followed_by_one_too_long(spark, monkeypatch):
    sizes = [size for room in range(60, 20, -1) for size in (1, room)]
    rows = [(i, " ".join(["w"] * size)) for i, size in enumerate(sizes)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("source", F.lit("s"))
    kept, staged = [], mixing.staged
    monkeypatch.setattr(mixing, "staged", lambda df, name: kept.append(name) or staged(df, name))
    # Documents come by number; 60 words are wanted.
    mixed = mixing.mix(docs, share=60.5 / sum(sizes), quality=F.pow(F.lit(1e-3), F.col("doc_id")))
    taken = {row.doc_id for row in mixed.where("copies > 0").collect()}
    assert taken == {i for i, size in enumerate(sizes) if size == 1} | {len(sizes) - 1}
    assert len(kept) <= 20


def test_words_that_begin_alike_are_searched_from_where_they_differ(monkeypatch):
    encoder, searched = sentencepiece.Encoder(sentencepiece.read_model()), []
    reach = sentencepiece.Encoder._reach

    def counted(self, window, ends, starts, first, last):
        searched.append(last - first)
        reach(self, window, ends, starts, first, last)

    monkeypatch.setattr(sentencepiece.Encoder, "_reach", counted)
    start = "undenlichverkeiten"
    words = [start + a + b for a in "abcdefghij" for b in "abcdefghij"]
    texts = [" ".join(words[i::3]) for i in range(3)] + ["", start * 5, "日本 \U0001f600"]
    library = SentencePieceProcessor(model_file=sentencepiece.MODEL)
    assert encoder.encode_all(texts) == [library.encode(text) for text in texts]
    assert sum(searched) < 6 * len(words)


def test_new_words_reach_the_library_in_short_texts():
    with open(alignment.BYTE_BPE, encoding="utf-8") as a, open(alignment.PIECE_BPE, "rb") as b:
        known = alignment.Aligner(a.read(), b.read())
    lengths, library = [], known.b

    class Counted:
        def __getattr__(self, name):
            return getattr(library, name)

        def encode(self, text):
            lengths.append(len(text))
            return library.encode(text)

    known.b = Counted()
    text = " ".join(f"word{i}" for i in range(5000))
    block = alignment.Block.of(known, [text, ""])
    assert block.sizes[1].tolist() == [len(library.encode(text)), 0]
    assert max(lengths) < 20 * alignment.AT_ONCE
