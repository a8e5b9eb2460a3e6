"""The corpus pipeline: quality rules, quality classifier, near duplicates, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept. ``run``
writes what a stage returns to the shared folder and reads it back for the next one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from terraquilt.llm import byte_cnn, minhash, mixing, packing, quality_rules
from terraquilt.llm.common import settle, small_batches, table
from terraquilt.llm.queries import MIX, tokenizer_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the isolation forest."""
    small_batches(spark)
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the byte network finds good, fitted on the labelled ones among them.

    It rejects below 0.5, where the labels' own two kinds divide.
    """
    small_batches(spark)
    net = byte_cnn.fit_quality(docs, table(spark, sf_dir, "labels"), byte_cnn.training_fold("doc_id", 3, 1))
    return byte_cnn.keep_quality(docs, net, 0.5)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity of 0.8 or more."""
    small_batches(spark)
    return minhash.drop_near_duplicates(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix_documents(docs, **MIX)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens."""
    small_batches(spark)
    return packing.pack_documents(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", rules_stage),
    ("quality classifier", classifier_stage),
    ("near duplicates", dedup_stage),
    ("mixing", mix_stage),
    ("packing", packing_stage),
]

#: Learned models, set similarity and the tokenizer are beyond SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
