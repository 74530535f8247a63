"""Corpus pipeline: quality, toxicity, near-duplicates, benchmark decontamination, SentencePiece ids.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; all but the last return the
columns of ``documents``. ``run`` writes every stage's result as Parquet into the shared folder and reads it again.
No stage needs a second look at rows an earlier one dropped, so a lost executor costs part of one stage only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from churnlab.llm import cotrain, decontam, simhash, toxicity, unigram
from churnlab.llm.common import configure, scratch_path, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose combined probability of good quality is below one half."""
    return cotrain.keep_good(docs, table(spark, sf_dir, "labels"))


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose toxicity score is one half or more."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each SimHash component, the one with the smallest id."""
    return simhash.keep_one(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that overlap a benchmark item."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds the SentencePiece ids of the whole text and whether they decode to it."""
    return unigram.encode_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality), ("toxicity", clean), ("near_duplicates", distinct), ("decontamination", uncontaminated),
    ("sentencepiece", encoded)]

#: Classifiers and Viterbi cuts are beyond SQL; tests/llm compares the pipeline with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
