"""Corpus pipeline: language ID, quality rules, near-duplicates, mixing, BPE.

Each stage takes (spark, docs, sf_dir), works on every row that its
predecessor kept and returns a DataFrame; it is written as Parquet and
read again before the next. All but the last return the columns of
``documents``. Null, empty and blank texts go in the first stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.llm import langid, mixing, rules, simhash
from tickwise.llm.common import fresh, labels_of, remainder_is, table
from tickwise.llm.queries import bpe_digests
from tickwise.session import stored


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps texts with a main language that makes up at least half of them."""
    model = langid.train(docs, ~remainder_is("doc_id", 5, 0))
    return langid.keep_identified(docs, model)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts that fail the base rules or that a learned rule names."""
    labels = labels_of(table(spark, sf_dir, "labels"), "quality")
    learned = rules.learn_from(stored(rules.statistics(docs), "rule_stats"), labels)
    row = fresh(docs.columns, "_document")
    measured = rules.statistics(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(row),
                                            F.col("text")), keep=[row])
    kept = measured.where(~rules.base_failed() & rules.verdict(learned).isNull())
    return kept.select(*[F.col(f"{row}.`{c}`").alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group that fingerprints link."""
    return simhash.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each document as often as the mix of the sources does."""
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each text."""
    return bpe_digests(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("mix", mix),
    ("tokens", tokens),
]

#: SQL can express neither the learned stages nor the tokens: the tests hold
#: each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
