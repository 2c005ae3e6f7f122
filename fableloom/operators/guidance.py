"""Reference data that goes with an item: taxonomy rules, decision-tree sections and minimal pairs for its labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.notation import strings

#: Rows of a guidance table at most; such tables are written by hand.
MAX_ROWS = 10_000


def _gathered(guidance: DataFrame, *order: str) -> DataFrame:
    """All rows as one array, after a check of their number."""
    rows = guidance.agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list(F.struct(*order, *[c for c in guidance.columns if c not in order]))).alias("rows"))
    fine = F.when(F.col("n") <= MAX_ROWS, F.col("rows")).otherwise(F.raise_error(F.lit(f"more than {MAX_ROWS} rows of guidance")).cast(rows.schema["rows"].dataType))
    return rows.select(fine.alias("rows"))


def with_rules(items: DataFrame, rules: DataFrame, labels: str = "labels") -> DataFrame:
    """items with ``rules``: those of rules(code, …) whose code is among the labels."""
    own = _gathered(rules, "code").scalar()
    return items.withColumn("rules", own).withColumn("rules", F.filter("rules", lambda r: F.array_contains(labels, r["code"])))


def with_minimal_pairs(items: DataFrame, pairs: DataFrame, labels: str = "labels", limit: int = 5) -> DataFrame:
    """items with ``minimal_pairs``: the first of pairs(pair_id, confusable_labels, …) that touch the labels, else the first of all."""
    own = _gathered(pairs, "pair_id").scalar()
    out = items.withColumn("minimal_pairs", own).withColumn("_fit", F.filter("minimal_pairs", lambda p: F.arrays_overlap(p["confusable_labels"], F.col(labels))))
    return out.withColumn("minimal_pairs", F.slice(F.when(F.size("_fit") > 0, F.col("_fit")).otherwise(F.col("minimal_pairs")), 1, limit)).drop("_fit")


def tree_sections(spark: SparkSession, text: str) -> DataFrame:
    """section_id (the first word of its heading) and text of the sections of a decision tree in Markdown."""
    own = spark.createDataFrame([(text,)], "t string").select(F.posexplode(F.split(F.concat(F.lit("\n"), F.col("t")), "\n## ")).alias("at", "text"))
    return own.where("at > 0").select(F.regexp_extract("text", r"^(\S+)", 1).alias("section_id"), F.concat(F.lit("## "), F.regexp_replace("text", r"\s+$", "")).alias("text"), "at")


def with_tree(items: DataFrame, sections: DataFrame, ids: str = "section_ids") -> DataFrame:
    """items with ``decision_tree``: the texts of the named sections in their order."""
    own = _gathered(sections.select("at", "section_id", "text"), "at").scalar()
    chosen = F.transform(F.filter("_all", lambda s: F.array_contains(F.coalesce(ids, strings()), s["section_id"])), lambda s: s["text"])
    return items.withColumn("_all", own).withColumn("decision_tree", F.array_join(chosen, "\n\n")).drop("_all")
