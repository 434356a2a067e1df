"""A corpus from raw documents: language, near copies, benchmark leaks, personal data, then the mix of the sources."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessella.llm import decontam, jaccard, langid, mixing, pii
from tessella.llm.common import forget, stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is rejected go: null texts, those without a letter, and those far from all that was learned.

    Rows without a lang are judged but not learned from; repeated rows stay or go alike; nothing is kept of a table from
    which nothing can be learned; an empty table gives an empty result; other columns stay as they are.
    """
    return langid.accepted(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that of the smallest doc_id; of repeated rows one stays.

    Unrelated texts that share a doc_id both stay, as do rows without a doc_id and texts of their own; null and blank
    texts are no copies of others; an empty table gives an empty result; other columns stay as they are.
    """
    return jaccard.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go.

    Null and empty texts hold none, rows without a doc_id stay, rows that share one stay or go together; an empty table
    gives an empty result; other columns stay as they are.
    """
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind in brackets; every document stays.

    A null text stays null, texts without personal data and all other columns, n_chars among them, stay as they are;
    rows of equal doc_id and text are changed alike; an empty table gives an empty result.
    """
    return pii.redacted(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, its copies numbered by the added column copy_no.

    Null and blank texts have no words and are not taken; rows equal in doc_id, source and size share their copies; a null
    source is a source; an empty table gives an empty result.
    """
    return mixing.mixed(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("ngram_jaccard", near_duplicates),
    ("decontamination", decontamination),
    ("pii", personal_data),
    ("mixing", mixture),
]

#: SQL can express neither the classifiers nor the balanced sample; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written as Parquet and read again by the next one; a table goes when the next is written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if before is not None:
            forget(before)
        before = docs
    return docs
