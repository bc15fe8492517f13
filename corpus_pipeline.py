"""A corpus pipeline of five stages: (spark, docs, sf_dir) -> DataFrame each."""

from __future__ import annotations

import posixpath
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from brookledger.llm.exact_dedup import without_copies
from brookledger.llm.jaccard_join import one_of_each_group
from brookledger.llm.language_id import in_known_language, learn
from brookledger.llm.mixing import mixed
from brookledger.llm.row_keys import free_names, numbered_copies
from brookledger.llm.sentencepiece_dropout import encoded
from brookledger.llm.shared_folder import written


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages."""
    corpus = spark.read.parquet(posixpath.join(sf_dir, "documents.parquet"))
    return in_known_language(docs, learn(corpus))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts."""
    return without_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts with similar word shingles."""
    return one_of_each_group(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, as often as it takes them, in training order."""
    return mixed(docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of each document, drawn anew for each of its copies, whether they decode to its text, and its position.

    Positions rise in training order, as the stage before wrote it.
    """
    copy, position = free_names(docs.columns, "_copy", "_position")
    return encoded(numbered_copies(docs, "doc_id", "text", copy, position), copy=copy, position=position)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("mixing", mixing_stage),
    ("sentencepiece", encoding_stage),
]

#: SQL cannot express the language model, so the pipeline is tested against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written and read again."""
    docs = spark.read.parquet(posixpath.join(sf_dir, "documents.parquet"))
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
