"""From raw documents to token ids: quality rules, near-duplicates, personal data, mixture, tokens.

Each stage takes the documents its predecessor kept and, but for the last, returns documents again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from bandwright.llm.common import table
from bandwright.llm.mixing import mixed_rows
from bandwright.llm.pii import redact
from bandwright.llm.quality_rules import apply_quality_rules
from bandwright.llm.sentencepiece import tokenize
from bandwright.llm.simhash import deduplicate
from bandwright.storage import remove, stage


def keep_good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject documents by rule, and take lines out that are frequent in their source."""
    return apply_quality_rules(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, that with the smallest id: SimHash of four-word shingles,
    linked at four differing bits or fewer."""
    return deduplicate(docs, words=4, bits=4)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data in the texts by its kind."""
    return redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sample and repeat documents so that the sources meet their target weights; a document taken twice is two rows."""
    return mixed_rows(docs)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mixture."""
    return tokenize(docs).select("doc_id", "lang", "source", "n_tokens", "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", keep_good_documents),
    ("simhash_near_dedup", drop_near_duplicates),
    ("pii", redact_personal_data),
    ("mixing", mix_sources),
    ("sentencepiece", encode_texts),
]

#: Near-duplicates and the tokenizer are beyond SQL; tests/llm holds the rows against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents, each written to the shared folder and read again by the next. A stage's
    table goes when the next one's is there."""
    docs, done = table(spark, sf_dir, "documents"), None
    for name, of in STAGES:
        docs, path = stage(of(spark, docs, sf_dir), f"pipeline-{name}")
        if done:
            remove(spark, done)
        done = path
    return docs
