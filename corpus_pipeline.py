"""A training-corpus pipeline: five operators applied to ``documents`` one after another.

Every stage returns the columns of ``documents``, extra ones included, and whole texts. Documents
without words, null texts included, are rejected by the first stage; a null id is kept like any
other, and comes last where a group of copies has to choose. Empty tables pass through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from regspan.llm.decontaminate import without_contaminated
from regspan.llm.frames import settle
from regspan.llm.minhash import drop_near_duplicates
from regspan.llm.mixing import mix
from regspan.llm.quality import passing as passing_classifier
from regspan.llm.rules import passing as passing_rules
from regspan.sources.sinks import keep

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a rule of the cascade go. As the first stage it settles the session."""
    settle(spark)
    return passing_rules(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold go.

    The model is fitted on all labelled documents, also those that the rules have rejected.
    """
    training = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return passing_classifier(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), training=training)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (5-word shingles, similarity 0.8) stays."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with benchmark passages in a twentieth of their words or more go."""
    return without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The corpus mixed to source weights; ``copy`` counts a document's copies from 0."""
    return mix(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

# The classifier has no SQL form; tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; what each returns is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), name)
    return docs
