"""The queries of this package: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..storage import fresh_path, remove
from .alignment import align_tokenizers
from .clusters import centroid_clusters
from .common import table
from .mixing import mix
from .neighbours import with_next
from .pii import BASE_KINDS, find_personal_data, joined_spans
from .quality_model import score_quality
from .quality_rules import quality_rules
from .repeats import remove_repeats
from .sentencepiece import decode, read_model, tokenize
from .secrets import BASE_KINDS as SECRET_KINDS, find_secrets
from .sharding import interleave
from .simhash import near_duplicates
from .sketch import containment, hex_digest, resemblance, sketch_documents, with_sketch
from .warc import page_captures, read_archives, write_archives


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op2_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = interleave(table(spark, sf_dir, "documents"), shards=8)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    captures = page_captures(read_archives(spark, path, payload=False)).drop("url")
    remove(spark, path)  # the captures are stored by now
    return captures


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words=4, bits=4)


def _count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(table(spark, sf_dir, "documents"))
    base = F.filter("pii", lambda x: x["kind"].isin(*BASE_KINDS))
    counts = [_count(F.col("pii"), kind).alias(f"n_{kind}") for kind in BASE_KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(joined_spans(base), 256).alias("base_sha256"), joined_spans(F.col("pii")).alias("spans")
    )


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("secrets", lambda x: x["kind"].isin(*SECRET_KINDS))
    counts = [_count(F.col("secrets"), kind).alias(f"n_{kind}") for kind in SECRET_KINDS]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(joined_spans(base), 256).alias("base_sha256"),
        joined_spans(F.col("secrets")).alias("spans"),
    )


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules(table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = read_model()
    tokens = tokenize(table(spark, sf_dir, "documents"), model=model)
    same = decode(F.col("ids"), model) == F.coalesce("text", F.lit(""))
    return tokens.select("doc_id", "n_tokens", "ids", same.alias("round_trip"))


def op10_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    sketched = sketch_documents(table(spark, sf_dir, "documents"))
    text = F.coalesce("text", F.lit(""))
    rows = with_next(
        sketched.select(F.col("doc_id").alias("id"), F.xxhash64(text).alias("tie"), text.alias("text"), "sketch"),
        ["text", "sketch"],
    )
    n, cut = F.length("text"), F.expr("length(text) div 3").cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - cut), F.substring("next_text", F.lit(1), cut))
    rows = rows.select(
        F.col("id").alias("doc_id"), n.cast("long").alias("n_chars"), "sketch", "next_sketch", edited.alias("edited")
    )
    rows = with_sketch(rows, "edited", "edited_sketch")
    own, other, following = F.col("sketch"), F.col("edited_sketch"), F.col("next_sketch")
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        hex_digest(own).alias("fingerprint"),
        hex_digest(other).alias("edited_fingerprint"),
        resemblance(own, other).alias("near_edited"),
        resemblance(own, following).alias("near_next"),
        containment(own, other).alias("contained_in_edited"),
    )


def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    clustered, _ = centroid_clusters(table(spark, sf_dir, "embeddings"), k=40, rounds=5, dims=64)
    return clustered.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeats(table(spark, sf_dir, "documents"), window=50)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = align_tokenizers(table(spark, sf_dir, "documents"))
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return aligned.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest.alias("groups_sha256")
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix_sources": op1_mix_sources,
    "op2_shard": op2_shard,
    "op3_quality_model": op3_quality_model,
    "op4_warc": op4_warc,
    "op5_simhash": op5_simhash,
    "op6_pii": op6_pii,
    "op7_secrets": op7_secrets,
    "op8_quality_rules": op8_quality_rules,
    "op9_sentencepiece": op9_sentencepiece,
    "op10_sketch": op10_sketch,
    "op11_centroid_clusters": op11_centroid_clusters,
    "op12_substring_dedup": op12_substring_dedup,
    "op13_tokenizer_alignment": op13_tokenizer_alignment,
}
