"""A training-corpus pipeline: quality rules, toxicity, near-dedup, benchmark decontamination, packing.

Each stage takes (spark, docs, sf_dir), with docs as the stage before left it,
and returns the columns of documents; the last returns the packed pieces. A
stage decides on its own input alone: thresholds, votes and classifiers are
fitted on what has come down to it. Nulls may stand in any column, further
columns of any name are carried along, and empty tables give empty ones.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fableloom.llm.common import materialise, table
from fableloom.llm.decontamination import drop_contaminated
from fableloom.llm.near_dups import drop_near_duplicates
from fableloom.llm.packing import pack_documents
from fableloom.llm.quality_rules import keep_good
from fableloom.llm.toxicity import fit_toxicity, toxicity_of


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and are good by posterior probability. Null and empty texts go."""
    return keep_good(docs)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5, by a classifier trained on the labelled ones among them. Without labels of both kinds all score the share of toxic labels."""
    score = toxicity_of(spark, fit_toxicity(docs, table(spark, sf_dir, "labels")))
    return docs.where(score(F.col("text")) < 0.5)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, the one with the smallest id (a missing id comes last; of repeated rows the first)."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of any benchmark item; all of them where the benchmark is empty."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens along the curve."""
    return pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: Expectation-maximisation and the classifier have no SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
