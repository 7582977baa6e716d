"""NULLs in any column, empty and very long texts, ties, repeated rows, empty tables, clashing names."""

import hashlib

import brute
import pytest
from bandwright.llm import common, mixing, neighbours, pii, quality_rules, secrets, sentencepiece, sharding, simhash, sketch
from bandwright.llm.mixing import mix, mixed_rows
from bandwright.llm.neighbours import with_next
from bandwright.llm.quality_model import score_quality
from bandwright.llm.warc import assemble, page_captures, read_archives, write_archives
from pyspark.sql import functions as F

LONG = "word%d other " * 4000 % tuple(range(4000)) + "mail me@example.com token=abcdefgh12345678\n" * 3
# Names that operators use inside or put out.
EXTRA = "size taken shard slot g a b fp u key id at ids pii secrets sketch features kept lines range tie".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` int" for n in EXTRA)


def frame(spark, rows):
    return spark.createDataFrame([(*row, *range(len(EXTRA))) for row in rows], SCHEMA)


ROWS = [
    (1, "one two three four five six seven eight nine ten eleven", "en", "s1", 55),
    (1, "one two three four five six seven eight nine ten eleven", "en", "s1", 55),  # a repeated row
    (2, "one two three four five six seven eight nine ten eleven", "en", "s2", 55),  # a copy
    (3, "", "en", "s1", 0),
    (4, None, None, None, None),
    (None, None, None, None, None),
    (None, "text without an id but with words enough to count as one document here", "de", None, 3),
    (5, LONG, "en", "s1", len(LONG)),
    (6, " \t\n\n ", "en", "s2", 5),
    (7, "é\x0bü\n" * 30, "fr", "s2", 120),
]


@pytest.fixture(scope="module")
def odd(spark):
    return frame(spark, ROWS)


@pytest.fixture(scope="module")
def nothing(spark):
    return frame(spark, [])


def test_mix(odd, nothing):
    rows = mix(odd).collect()
    assert len(rows) == len(ROWS)
    for row in rows:
        assert row["size"] == len(brute.words(row.text)) and 0 <= row.taken <= 2 * row["size"]
    assert mix(nothing).count() == 0
    again = {(r.doc_id, r.text, r.source): r.taken for r in mix(odd.repartition(7)).collect()}
    assert again == {(r.doc_id, r.text, r.source): r.taken for r in rows}
    repeated = mixed_rows(odd)
    assert repeated.columns == odd.columns
    assert repeated.where("text IS NULL").isEmpty()


def test_shards(odd, nothing):
    rows = sharding.interleave(odd, shards=3).collect()
    assert sorted((r.shard, r.slot) for r in rows) == [(0, i) for i in range(4)] + [
        (s, i) for s in (1, 2) for i in range(3)
    ]
    assert sharding.interleave(nothing).count() == 0
    assert {r.shard for r in sharding.interleave(odd.limit(2), shards=8).collect()} <= set(range(8))


def test_shard_files(spark, odd, tmp_path):
    sharding.write_shards(odd, str(tmp_path / "out"), shards=2)
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(ROWS)


def test_quality_model(spark, odd, nothing):
    labels = spark.createDataFrame([(1, 1), (5, 0), (None, 1), (7, None), (99, 0)], "doc_id long, quality int")
    rows = score_quality(odd, labels).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 for r in rows)
    assert score_quality(nothing, labels).count() == 0
    assert {r.score for r in score_quality(odd, labels.limit(0)).collect()} == {0.5}


def test_simhash(odd, nothing):
    got = sorted((r.fingerprint, r.component_id or -1) for r in simhash.near_duplicates(odd).collect())
    prints, least = brute.components([(row[0], row[1]) for row in ROWS])
    assert got == sorted((f"{p:016x}", c or -1) for p, c in zip(prints, least))
    assert simhash.near_duplicates(nothing).count() == 0
    kept = simhash.deduplicate(odd)
    assert kept.columns == odd.columns
    assert sorted((r.doc_id or -1) for r in kept.collect()) == [-1, 1, 3, 5, 7]
    with pytest.raises(ValueError):
        simhash.near_duplicates(odd, bits=6)


def test_pii(odd, nothing):
    for row in pii.find_personal_data(odd).collect():
        assert [tuple(s) for s in row.pii] == brute.pii_spans(row.text)
    assert pii.find_personal_data(nothing).count() == 0
    clean = {r.doc_id: r for r in pii.redact(odd).where("doc_id IS NOT NULL").collect()}
    assert clean[4].text is None and clean[5].n_chars == len(clean[5].text)
    assert "me@example.com" not in clean[5].text and "[EMAIL]" in clean[5].text


def test_secrets(odd, nothing):
    for row in secrets.find_secrets(odd).collect():
        base = [tuple(s) for s in row.secrets if s.kind != "random"]
        assert base == brute.secret_spans(row.text)
    assert secrets.find_secrets(nothing).count() == 0


def test_quality_rules(odd, nothing):
    got = quality_rules.quality_rules(odd, min_documents=1, share=0.1)
    want = brute.quality([(row[3], row[1]) for row in ROWS], min_documents=1, share=0.1)
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    rows = sorted(got.collect(), key=key)
    for row, (_, (rules, lost, kept, _)) in zip(rows, sorted(zip(ROWS, want), key=lambda x: key(x[0]))):
        assert {name: row[name] for name in rules} == rules
        assert (row.lost, row.kept) == (lost, kept)
    assert quality_rules.quality_rules(nothing).count() == 0
    kept = quality_rules.apply_quality_rules(odd)
    assert kept.columns == odd.columns and kept.where("n_chars <> length(text)").where("doc_id = 5").isEmpty()


def test_frequent_lines_go(spark):
    own = "line number {} says something of its own in many words here"
    rows = [(i, own.format(i) + "\nAll rights  reserved by the owner", "en", "s", 0) for i in range(20)]
    rows += [(20 + i, "all RIGHTS reserved by the owner\n" * 2 + "left", "en", "s", 0) for i in range(2)]
    rows += [(30, own.format(30) + "\nAll rights reserved by the owner", "en", "other", 0)]
    left = {r.doc_id: r for r in quality_rules.apply_quality_rules(frame(spark, rows)).collect()}
    assert sorted(left) == [*range(20), 30]  # two lose nearly everything
    assert left[3].text == own.format(3) and left[3].n_chars == len(left[3].text)
    assert left[30].text.endswith("owner")  # not frequent in its own source


def test_copies_are_not_frequent(spark):
    rows = [(i, "the same text of more than ten words in every one of these rows\nand more", "en", "s", 0) for i in range(50)]
    assert quality_rules.apply_quality_rules(frame(spark, rows)).count() == 50


def test_tokens(odd, nothing):
    for row in sentencepiece.tokenize(odd).collect():
        assert row.n_tokens == len(row.ids) and (row.n_tokens == 0) == (not row.text)
    assert sentencepiece.tokenize(nothing).count() == 0


def test_sketch(odd, nothing):
    for row in sketch.sketch_documents(odd).collect():
        assert (not row.sketch) == (not brute.words(row.text))
        assert row.sketch == sorted(set(row.sketch))
    assert sketch.sketch_documents(nothing).count() == 0


@pytest.mark.parametrize("ids", [[], [5], [3, 3, 3], [1, 2, 10**15, None, None], list(range(3000))])
def test_next_row(spark, ids):
    rows = spark.createDataFrame([(x, i, f"t{i}") for i, x in enumerate(ids)], "id long, tie long, text string")
    got = {r.text: r.next_text for r in with_next(rows, ["text"]).collect()}
    order = sorted(((x is not None, x or 0, i) for i, x in enumerate(ids)), reverse=True)
    numbered = [i for some, _, i in order if some]
    for k, i in enumerate(numbered[:-1]):
        assert got[f"t{i}"] == f"t{numbered[k + 1]}"
    assert sorted(got.values()) == sorted(got)  # a ring: everyone follows someone
    if ids and None not in ids:
        assert got[f"t{numbered[-1]}"] == f"t{numbered[0]}"


def test_archives(spark, tmp_path):
    big = "<p>é</p>" * 200
    tricky = "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n" * 40
    pages = [
        (1, "http://a.example/x?y=1#z", big, 0),
        (2, None, big, 0),
        (2, None, big, 0),
        (3, "bad url\r\nWARC-Type: revisit", "", 0),
        (4, "", None, 0),
        (None, "http://b.example", big, 0),
        (5, "http://c.example", tricky, 0),
        (6, 'http://d.example/"quoted"', "x" * 999, 0),
        (7, "http://d.example", "x" * 999, 0),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, digest int")
    write_archives(df, str(tmp_path / "warc"))
    rows = page_captures(read_archives(spark, str(tmp_path / "warc"))).collect()
    import hashlib

    want = []
    for key, url, html, _ in pages:
        body = (html or "").encode()
        again = body == big.encode() and key != 2
        want.append(
            (key, url, len(body), hashlib.sha1(body).hexdigest(), "revisit" if again else "response", 2 if again else None)
        )
    place = lambda x: str(x)
    assert sorted(map(tuple, rows), key=place) == sorted(want, key=place)
    write_archives(df.limit(0), str(tmp_path / "none"))


def test_single_source_holds_most_rows(spark):
    rows = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.concat(F.lit("word "), F.col("id")).alias("text"),
        F.lit("en").alias("lang"),
        F.when(F.col("id") % 10 == 0, "small").otherwise("big").alias("source"),
        F.lit(1).cast("long").alias("n_chars"),
    )
    sums = {r.source: r for r in mix(rows).groupBy("source").agg(F.sum("taken").alias("t"), F.max("target").alias("x")).collect()}
    assert all(abs(r.t - r.x) <= 2 for r in sums.values())
    shards = sharding.interleave(rows).groupBy("shard", "source").count().collect()
    assert {r["count"] for r in shards if r.source == "small"} <= {37, 38}


def test_mix_fills_until_nothing_fits(spark):
    # In key order: 50 short, one of 130, 20 short, one of 100, 1,000 short; room 150.
    sizes = [1] * 50 + [130] + [1] * 20 + [100] + [1] * 1000
    digest = lambda text: hashlib.md5(text.encode()).hexdigest()
    rows, number = [], 0
    drawn = [{n: int(digest(f"42:{i}:{digest(' '.join(['w'] * n))}")[:13], 16) for n in {1, 100, 130}} for i in range(60_000)]
    for n, top in zip(sizes, range(len(sizes), 0, -1)):
        # The next id whose key lies in the next slice of the order.
        low, high = (top - 1) / len(sizes) * 2**52, top / len(sizes) * 2**52
        number = next(i for i, keys in enumerate(drawn) if keys is not None and low <= keys[n] < high)
        drawn[number] = None
        rows.append((number, " ".join(["w"] * n), "en", "one"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    share = 150 / sum(sizes)
    assert mix(docs, share=share).agg(F.sum("taken")).first()[0] == 150
    many = [(k, " ".join(["w"] * (1 + k * k % 97)), "en", f"s{k % 3}") for k in range(400)]
    docs = spark.createDataFrame(many, "doc_id long, text string, lang string, source string")
    left = F.expr("copies = floor(target / source_size)")
    for row in (
        mix(docs, share=0.7)
        .groupBy("source")
        .agg(F.sum("taken").alias("t"), F.max("target").alias("x"), F.min(F.when(left, F.col("size"))).alias("s"))
        .collect()
    ):
        assert abs(row.t - row.x) <= (row.s or 0) / 2


def test_mix_tries_the_first_that_did_not_fit(spark, monkeypatch):
    sizes = [2, 16, 47, 71, 275, 350, 443, 636, 665, 2770]
    docs = spark.createDataFrame([(i, " ".join(["w"] * n), "s") for i, n in enumerate(sizes)], "doc_id long, text string, source string")
    missed = {}
    for near in (mixing.NEAR, 1.0):
        monkeypatch.setattr(mixing, "NEAR", near)
        row = mix(docs, share=2864.66 / sum(sizes)).agg(F.sum("taken").alias("t"), F.max("target").alias("x")).first()
        missed[near] = abs(row.t - row.x)
    assert missed[0.01] <= 30 < 300 < missed[1.0]


def _hot(spark, n=30_000):
    """A third of the rows without an id, a third with one and the same, and the sources of one row each."""
    key = F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, F.lit(7)).otherwise(F.col("id"))
    return spark.range(n).select(
        key.alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"), F.lit("en").alias("lang"),
        F.col("id").cast("string").alias("single"), F.lit("one").alias("source"),
    )


@pytest.mark.parametrize("source", ["source", "single"])
def test_ties_are_spread(spark, source, monkeypatch):
    docs, seen = _hot(spark), []
    real = common.running

    def spied(df, group, position, *rest):
        bucket = F.floor(position * common.BUCKETS)
        whole, largest = df.groupBy(group, bucket.alias("b")).count().agg(F.sum("count"), F.max("count")).first()
        seen.append(largest / whole)
        return real(df, group, position, *rest)

    monkeypatch.setattr(sharding, "running", spied)
    monkeypatch.setattr(mixing, "running", spied)
    placed = sharding.interleave(docs, source=source)
    counts = {r.shard: r["count"] for r in placed.groupBy("shard").count().collect()}
    assert sorted(counts) == list(range(8)) and max(counts.values()) - min(counts.values()) <= 1
    if source == "source":
        mix(docs).count()
    assert len(seen) >= 2 and max(seen) < 0.01


def test_next_of_hot_ids_is_spread(spark):
    rows = _hot(spark).select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("tie"), "text")
    n = rows.count()
    placed = rows.groupBy(neighbours._range_of(rows.select("id", "tie"), n).alias("range")).count()
    assert placed.agg(F.max("count")).first()[0] < 0.1 * n
    got = neighbours.with_next(rows, ["text"]).collect()
    order = sorted(got, key=lambda r: (r.id is not None, r.id or 0, r.tie), reverse=True)
    assert [r.next_text for r in order] == [r.text for r in [*order[1:], order[0]]]


def test_ranges_of_the_order_compile(spark):
    ids = [None if i % 97 == 0 else (i * 7919) % 30011 - 9000 for i in range(3000)] + [77] * 300
    rows = spark.createDataFrame(list(enumerate(ids)), "n long, id long").withColumn("tie", F.xxhash64("n"))
    spark.conf.set("spark.sql.codegen.fallback", "false")  # code over 64 KB is an error, and is not left for slower code
    try:
        placed = rows.withColumn("range", neighbours._range_of(rows.select("id", "tie"), 512 * 200)).collect()
        got = with_next(rows, ["n"]).collect()
    finally:
        spark.conf.unset("spark.sql.codegen.fallback")
    order = sorted(placed, key=lambda r: (r.id is not None, r.id or 0, r.tie))
    ranges = [r.range for r in order]
    assert ranges == sorted(ranges) and len(set(ranges)) > 100
    assert all((r.range < 0) == (r.id is None) for r in placed)
    following = {r.n: r.next_n for r in got}
    assert following == {r.n: order[i - 1].n for i, r in enumerate(order)}


def test_revisits_name_the_response_they_repeat(spark, tmp_path):
    big, twice = "b" * 1500, "t" * 2000
    pages = [(1, "http://a/ 1", big), (9, "http://a/9", big), (3, None, big), (None, "http://n", big),
             (5, "http://x", twice), (8, "http://x", twice), (8, "http://x", twice), (8, "http://w", twice)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    write_archives(df, str(tmp_path / "warc"))
    records = read_archives(spark, str(tmp_path / "warc"))
    rows = {r.record_id: r for r in records.collect()}
    assert len(rows) == 3 * len(pages)
    by_digest = {hashlib.sha1(x.encode()).hexdigest(): x for x in (big, twice)}
    for row in rows.values():
        if row.type == "revisit" and by_digest[row.declared_digest] == big:
            assert rows[row.refers_to].type == "response" and rows[row.refers_to].target_uri == "http://a/9"
        elif row.type == "revisit":
            assert row.refers_to is None  # the response is there twice
    assert sorted(r.page_id or 0 for r in page_captures(records).collect()) == [0, 1, 3, 5, 8, 8, 8, 9]
    # Of several records of one kind the one with the smallest id counts, in whatever order they come.
    extra = records.where("type = 'request'").limit(1).withColumn("record_id", F.lit("<urn:uuid:0>"))
    for mixed in (records.unionByName(extra), extra.unionByName(records)):
        capture = extra.first().concurrent_to
        (row,) = assemble(mixed).where(F.col("capture_id") == capture).collect()
        assert row.request.record_id == "<urn:uuid:0>"


def test_empty_archives(spark, tmp_path):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    write_archives(none, str(tmp_path / "none"))
    assert page_captures(read_archives(spark, str(tmp_path / "none"))).count() == 0
