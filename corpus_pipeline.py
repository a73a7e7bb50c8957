"""Clean a corpus in five stages, each one of the training-data operators over all that is left.

Stages hand over the columns of ``documents``; the last adds what mixing gives. Each stage's
result is written to the shared folder and read again, so a lost executor costs that stage's
tasks only. Every stage takes tables without rows, null, empty and very long texts, repeated rows
and keys, and further columns of any name, as the operator it calls documents. Whole rows go through
Python in two stages, whose results run after they are returned: these leave the session with batches
of about 4 MB.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from assay.llm import decontaminate, jaccard_join, mixing, pii, quality_rules
from assay.llm.common import bounded_batches, clear_name, staged, table
from assay.llm.queries import labelled_domains


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor the learned ones reject."""
    bounded_batches(spark)
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of alike ones."""
    return jaccard_join.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    bounded_batches(spark)
    found = clear_name(docs, "contamination")
    marked = decontaminate.find_contamination(
        docs, table(spark, sf_dir, "benchmark"), keep=tuple(docs.columns), name=found
    )
    return marked.where(f"not `{found}`.contaminated").drop(found)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced by its kind."""
    return pii.redact(docs)


def mixing_rates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their tokens, domain posteriors and rates in ``mixing``."""
    return mixing.mix_sources(
        docs, labelled_domains(spark, sf_dir), name=clear_name(docs, "mixing")
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality),
    ("ngram_jaccard_join", near_duplicates),
    ("decontamination", decontamination),
    ("pii", personal_data),
    ("source_mixing", mixing_rates),
]

# Learned rules, components and fitted rates have no SQL form; tests hold each stage against a
# brute-force version, the learned rules and rates where nothing is to be learned.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
