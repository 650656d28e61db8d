"""The training corpus pipeline: five stages over ``documents``, each written and read again.

Language ID rejects documents without a clear language; of documents whose fingerprints are near one stays; documents that hold
benchmark passages go; secrets are replaced inside the texts; at last sources are mixed to their target
weights, which emits documents as often as they have copies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from filingloom.llm import contamination, language, mixing, secrets, simhash
from filingloom.sinks.workspace import staged


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fit on this stage's labelled documents and keep what has a clear language."""
    return language.accepted(docs, language.fit(docs, ~language.held_out()))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return contamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redacted(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


STAGES = [
    ("language", known_language),
    ("near_copies", without_near_copies),
    ("benchmark", without_benchmark),
    ("secrets", without_secrets),
    ("mix", mix),
]

#: SQL has no counterpart of the classifiers and fingerprints; tests compare stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; each result is a Parquet table in the shared folder and the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
