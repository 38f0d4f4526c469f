"""A training corpus from documents, stage by stage; each stage's rows are written before the next."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from gridspark.llm import exact_dedup, language_id, ngram_jaccard, packing, secret_scan
from gridspark.llm.common import configure, discard, stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def as_job(stage: Stage) -> Stage:
    """The stage in a session with the settings of a large job."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        configure(spark)
        return stage(spark, docs, sf_dir)

    return run


@as_job
def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised."""
    return language_id.drop_unknown_languages(docs)


@as_job
def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest doc_id."""
    return exact_dedup.drop_exact_duplicates(docs)


@as_job
def distinct_contents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-duplicates (five words, 0.8) the document with the smallest doc_id."""
    return ngram_jaccard.drop_near_duplicates(docs)


@as_job
def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced in their texts."""
    return secret_scan.redact_secrets(docs)


@as_job
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens."""
    return packing.pack(docs, added=True, forget=True)


STAGES: list[tuple[str, Stage]] = [
    ("language", known_language),
    ("exact", distinct_texts),
    ("near", distinct_contents),
    ("secrets", without_secrets),
    ("packing", packed),
]

#: Trained models and tokens are beyond SQL; a brute-force version tests the pipeline instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        before, docs = docs, stored(stage(spark, docs, sf_dir))
        discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
