"""Corpus pipeline: toxicity, exact dedup, near-dedup, mixing, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickweave.llm import best_fit, exact_dedup, minhash, mixing, toxicity
from tickweave.llm.work import cut, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

TOXIC_FROM = 0.3
TARGETS = {"good": 0.86, "low": 0.14}


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the toxicity threshold (8)."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), toxicity.bucket4("__id") != 2)
    return docs.filter(model.column("text")[0] < TOXIC_FROM)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts (9)."""
    return exact_dedup.dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component: five words, Jaccard 0.8 (7)."""
    return minhash.dedup(docs)


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that low and good quality reach their target shares; none is left out (10)."""
    domain = F.when(F.col("quality") == 1, 0).when(F.col("quality") == 0, 1)
    return mixing.mix(docs, table(spark, sf_dir, "labels"), TARGETS, domain, all_stay=True)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces placed in sequences of 1024 (5)."""
    return best_fit.pack(docs).withColumnRenamed("id", "doc_id")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("minhash near-dedup", drop_near_copies),
    ("mixing", mix_domains),
    ("best-fit packing", pack),
]

# Learned scores, fitted rates and packing have no SQL form; tests hold run() against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = cut(docs, name.replace(" ", "-"))
    return docs
