"""Every query on the driver's tables against SQL or the plain version."""

import brute
import oracle
import pytest
import sentencepiece
from bandwright.llm import oracles, queries
from bandwright.llm.sentencepiece import MODEL


@pytest.fixture(scope="module")
def docs(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "source", "text").collect()
    return [tuple(row) for row in rows]


def rows_of(df):
    return {row.doc_id: row for row in df.collect()}


@pytest.mark.parametrize("name", sorted(oracles.ORACLE))
def test_equals_sql(spark, sf, name):
    assert oracle.differences(queries.QUERIES[name](spark, sf), oracle.connect(sf), oracles.ORACLE[name]) == []


def test_mix_meets_targets(spark, sf):
    rows = queries.op1_mix_sources(spark, sf)
    sums = rows.join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "source"), "doc_id")
    for row in sums.groupBy("source").agg({"taken": "sum", "target": "max", "size": "max"}).collect():
        assert abs(row["sum(taken)"] - row["max(target)"]) <= 30 + 0.06 * row["max(target)"]
    assert rows.where("taken > 2 * size").isEmpty()


def test_shards(spark, sf, docs):
    import zlib

    got = rows_of(queries.op2_shard(spark, sf))
    assert len(got) == len(docs)
    for key, source, text in docs:
        assert got[key]["size"] == len(text.encode()) + 1 and got[key].text_crc32 == zlib.crc32(text.encode())
    slots = {}
    for row in got.values():
        slots.setdefault(row.shard, []).append(row.slot)
    assert sorted(slots) == list(range(8))
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    mix = {}
    for key, source, _ in docs:
        mix.setdefault(source, [0] * 8)[got[key].shard] += 1
    assert all(max(own) - min(own) <= 2 for own in mix.values())


def test_quality_model(spark, sf):
    rows = queries.op3_quality_model(spark, sf)
    judged = rows.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    assert all(0 <= row.score <= 1 and row.predicted == (row.score >= 0.7) for row in judged)
    assert sum(row.predicted == row.quality for row in judged) >= 0.9 * len(judged)


def test_simhash(spark, sf, docs):
    got = rows_of(queries.op5_simhash(spark, sf))
    prints, least = brute.components([(key, text) for key, _, text in docs])
    for (key, _, _), print_, component in zip(docs, prints, least):
        assert (got[key].fingerprint, got[key].component_id) == (f"{print_:016x}", component)


def test_pii(spark, sf, docs):
    got = rows_of(queries.op6_pii(spark, sf))
    for key, _, text in docs:
        base = brute.joined(brute.pii_spans(text))
        assert got[key].base_sha256 == brute.sha256(base)
        assert got[key].spans == base or got[key].spans.startswith(base + ",") or not base


def test_secrets(spark, sf, docs):
    got = rows_of(queries.op7_secrets(spark, sf))
    for key, _, text in docs:
        base = brute.secret_spans(text)
        assert got[key].base_sha256 == brute.sha256(brute.joined(base))
        assert got[key].n_assign == sum(kind == "assign" for kind, _, _ in base)
        assert {brute.joined([span]) for span in base} <= set(got[key].spans.split(","))


def test_quality_rules(spark, sf, docs):
    got = rows_of(queries.op8_quality_rules(spark, sf))
    for (key, _, _), (rules, _, kept, _) in zip(docs, brute.quality([(s, t) for _, s, t in docs])):
        row = got[key].asDict()
        assert {name: row[name] for name in rules} == rules and row["kept"] == kept


def test_sentencepiece(spark, sf, docs):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    got = rows_of(queries.op9_sentencepiece(spark, sf))
    for key, _, text in docs:
        assert got[key].ids == library.encode(text) and got[key].round_trip


def test_sketch(spark, sf, docs):
    got = rows_of(queries.op10_sketch(spark, sf))
    edited = brute.edited_texts([(key, text) for key, _, text in docs])
    errors = []
    for key, _, text in docs:
        row, (changed, following) = got[key], edited[key]
        assert row.n_chars == len(text) and row.edited_sha256 == brute.sha256(changed)
        a, b, c = map(brute.shingle_set, (text, changed, following))
        errors.append(row.near_edited - len(a & b) / max(1, len(a | b)))
        assert abs(row.near_next - len(a & c) / max(1, len(a | c))) < 0.35 or len(a) < 60
    assert abs(sum(errors) / len(errors)) < 0.05
    prints = {}
    for key, _, text in docs:
        assert prints.setdefault(text, got[key].fingerprint) == got[key].fingerprint
