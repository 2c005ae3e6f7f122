"""Sums of a document's units, relations and chains."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def document_rollups(units: DataFrame, relations: DataFrame | None = None, chains: DataFrame | None = None) -> DataFrame:
    """One row for each document with units: unit_count, char_count, has_timestamps, and needs_review_count, flag_count, unclassified_count, relation and chain counts where their columns or tables are given.

    char_count is the length of the units' texts, one space apart.
    """
    has = set(units.columns)
    sums = [F.count(F.lit(1)).alias("unit_count"), (F.sum(F.length("text") + 1) - 1).alias("char_count")]
    sums.append((F.max(F.col("start_ms").isNotNull()) if "start_ms" in has else F.lit(False)).alias("has_timestamps"))
    if "needs_review" in has:
        sums.append(F.count_if("needs_review").alias("needs_review_count"))
    if "validator_flags" in has:
        sums.append(F.sum(F.greatest(F.lit(0), F.size("validator_flags"))).alias("flag_count"))
    if "method" in has:
        sums.append(F.count_if(F.col("method") == "none").alias("unclassified_count"))
    out = units.groupBy("document_id").agg(*sums)
    for frame, name in ((relations, "relation"), (chains, "chain")):
        if frame is not None:
            own = frame.groupBy("document_id").agg(F.count(F.lit(1)).alias(f"{name}_count"), F.count_if("needs_review").alias(f"{name}_needs_review_count"))
            out = out.join(own, "document_id", "left").fillna(0, [f"{name}_count", f"{name}_needs_review_count"])
    return out
