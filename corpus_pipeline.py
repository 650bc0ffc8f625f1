"""The corpus pipeline: from documents to packed training sequences.

Each stage takes what the one before it kept, written as Parquet and read again, and decides for
good: the classifier rejects documents, exact and near deduplication leave one document of each
group, mixing repeats documents of sources below their weight, and packing returns the pieces of
what is left. All but the last return the columns of ``documents``.

The stages train models, follow links and tokenise, which SQL can't express, so there is no
``ORACLE_SQL``; tests hold every stage against a brute-force version on a small corpus.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from debtlens.llm import exact_dedup, mixing, near_dedup, packing, quality
from debtlens.llm.scratch import begin_small_batches, end_small_batches, stored

#: Near copies are texts of at least this similarity.
NEAR_PERCENT = 80

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def accept_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality classifier accepts."""
    # The caller writes the result; until the next stage begins, batches of whole texts are small.
    begin_small_batches(spark)
    return quality.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the one with the largest id."""
    end_small_batches(spark)
    return exact_dedup.without_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of texts linked at ``NEAR_PERCENT``, the one with the smallest id."""
    return near_dedup.one_per_group(docs, percent=NEAR_PERCENT)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, those of light sources again until the weights hold."""
    return mixing.rebalanced(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequence and offset."""
    return stored(packing.packed(docs), "packed")


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", accept_quality),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, from the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
