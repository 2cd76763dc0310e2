"""From documents to training sequences: filter, deduplicate, mix and pack, one operator of ``topiclog.llm`` a stage."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from topiclog.llm.base import stored, table
from topiclog.llm.exactdup import without_exact_duplicates
from topiclog.llm.mixing import mixture
from topiclog.llm.neardup import without_near_duplicates
from topiclog.llm.packing import sequences
from topiclog.llm.quality import good

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below 0.7 go; the classifier learns from the labelled ones among ``docs``."""
    return good(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents equal but for white space, the one with the smallest doc_id stays."""
    return without_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: shingles of five words, similarity of 0.8 or more."""
    return without_near_duplicates(docs, words=5, percent=80)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources of what is left, mixed to weights 3, 1, 2 in turn; a document that is taken twice is there twice."""
    return mixture(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids in sequences of at most 2048: doc_id, start, length, ids, doc_tokens, sequence_id, offset."""
    return sequences(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality), ("exact dedup", exact_dedup), ("near dedup", near_dedup), ("mixing", mixing), ("packing", packing),
]
# A trained model, hashes and a tokenizer are not SQL; the tests compare each stage with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written and read again."""
    docs = table(spark, sf_dir, "documents")
    *stages, (_, last) = STAGES
    docs = functools.reduce(lambda kept, stage: stored(stage[1](spark, kept, sf_dir), "stage"), stages, docs)
    return last(spark, docs, sf_dir)
