"""The pipeline against the plain versions of its stages."""

import brute
import corpus_pipeline
import sentencepiece
from bandwright.llm.sentencepiece import MODEL


def test_stages(spark, sf, tmp_path):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before = [tuple(r) for r in docs.collect()]
    outputs = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        outputs[name] = docs.collect()
        if name != "sentencepiece":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]

    judged = brute.quality([(row[3], row[1]) for row in before])
    good = {row[0]: text for row, (_, _, kept, text) in zip(before, judged) if kept}
    assert {r.doc_id: r.text for r in outputs["quality_rules"]} == good

    ids = sorted(good)
    _, least = brute.components([(i, good[i]) for i in ids], bits=4, size=4)
    assert sorted(r.doc_id for r in outputs["simhash_near_dedup"]) == sorted(set(least))

    for row in outputs["pii"]:
        spans = brute.pii_spans(good[row.doc_id])
        assert not brute.pii_spans(row.text) and row.n_chars == len(row.text)
        if not spans:
            assert row.text == good[row.doc_id]

    redacted = {r.doc_id: r.text for r in outputs["pii"]}
    assert {r.doc_id for r in outputs["mixing"]} <= set(redacted)
    assert all(r.text == redacted[r.doc_id] for r in outputs["mixing"])
    counts = {}
    for r in outputs["mixing"]:
        counts[r.doc_id] = counts.get(r.doc_id, 0) + 1
    assert max(counts.values()) <= 2

    assert len(outputs["sentencepiece"]) == len(outputs["mixing"])
    for row in outputs["sentencepiece"]:
        assert row.ids == library.encode(redacted[row.doc_id]) and row.n_tokens == len(row.ids)


def test_run(spark, sf):
    assert corpus_pipeline.run(spark, sf).count() > 0
