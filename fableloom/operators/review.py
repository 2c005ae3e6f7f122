"""Which units people should look at, and the vote of a committee on them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import lexicon as L
from ..functions.notation import group_labels, strings
from ..functions.text import hash_id
from .evaluate import ratio
from .segment import around, with_neighbours


def review_reasons(conflicted: Column) -> Column:
    """Reasons of a unit, in fixed order; conflicted: whether a similarity conflict names it."""
    tests = [
        (F.col("needs_review"), "needs_review"),
        (F.size("validator_flags") > 0, "validator_flags"),
        (conflicted, "similarity_conflict"),
        (F.size(group_labels(F.col("functions"), L.REVIEW_CONFUSION_GROUPS)) > 0, "confusable_functions"),
        (F.col("emotion_intensity") >= L.REVIEW_INTENSITY, "intense_emotion"),
        (F.size("emotions_mentioned") > 0, "emotions_mentioned"),
        (F.size("functions") > L.REVIEW_FUNCTIONS, "many_functions"),
        (F.col("confidence") < L.REVIEW_CONFIDENCE, "low_or_medium_confidence"),
    ]
    return F.filter(F.array(*[F.when(F.coalesce(t, F.lit(False)), F.lit(n)) for t, n in tests]), lambda r: r.isNotNull())


def difficulty(reasons: Column) -> Column:
    hard, medium = strings("similarity_conflict", "confusable_functions"), strings("validator_flags", "needs_review", "low_or_medium_confidence")
    return F.when(F.arrays_overlap(reasons, hard), "hard").when(F.arrays_overlap(reasons, medium), "medium").otherwise("easy")


def goal(reasons: Column) -> Column:
    return F.when(F.arrays_overlap(reasons, strings("similarity_conflict", "confusable_functions")), "resolve_confusion").when(F.arrays_overlap(reasons, strings("validator_flags", "needs_review")), "find_alternative").otherwise("validate")


def build_review_set(units: DataFrame, conflicts: DataFrame | None = None, minimal_pairs: DataFrame | None = None, qa_sample: int = L.QA_SAMPLE) -> DataFrame:
    """review_item_id, item_type, unit_ids, reasons, difficulty, goal, text and two texts of context on either side.

    In order of priority: units with a reason, conflicting pairs, a sample of the
    surest clean units, minimal pairs(pair_id, text_a, text_b). Of equal ids the
    first in that order stays.
    """
    own = with_neighbours(units, 2, 2, lambda order: {"context_before": around(order, 2, 1), "context_after": around(order, -1, -2)})
    if conflicts is None:
        own = own.withColumn("_conflicted", F.lit(False))
    else:
        named = conflicts.select(F.explode(F.array("unit_id_a", "unit_id_b")).alias("unit_id")).distinct().withColumn("_conflicted", F.lit(True))
        own = own.join(named, "unit_id", "left").withColumn("_conflicted", F.coalesce("_conflicted", F.lit(False)))
    own = own.withColumn("reasons", review_reasons(F.col("_conflicted")))
    shape = ["item_type", "unit_ids", "reasons", "difficulty", "goal", "text", "context_before", "context_after", "priority", "review_item_id"]
    flagged = own.where(F.size("reasons") > 0).withColumns(
        {"item_type": F.lit("unit"), "unit_ids": F.array("unit_id"), "difficulty": difficulty(F.col("reasons")), "goal": goal(F.col("reasons")), "priority": F.lit(0), "review_item_id": hash_id("review_", "unit", F.col("unit_id"), F.array_join("reasons", ","))}
    )
    parts = [flagged.select(*shape)]
    if conflicts is not None:
        text = lambda side: units.select(F.col("unit_id").alias(f"unit_id_{side}"), F.col("text").alias(f"text_{side}"))
        pairs = conflicts.join(text("a"), "unit_id_a").join(text("b"), "unit_id_b")
        parts.append(pairs.select(
            F.lit("similar_pair").alias("item_type"), F.array("unit_id_a", "unit_id_b").alias("unit_ids"), strings("similarity_conflict").alias("reasons"), F.lit("hard").alias("difficulty"), F.lit("resolve_confusion").alias("goal"),
            F.concat_ws("\n", "text_a", "text_b").alias("text"), strings().alias("context_before"), strings().alias("context_after"), F.lit(1).alias("priority"), hash_id("review_", "similar_pair", F.col("conflict_id")).alias("review_item_id"),
        ))
    sure = own.where((F.col("confidence") >= L.REVIEW_CONFIDENCE) & ~F.col("needs_review") & (F.size("validator_flags") == 0)).orderBy(F.desc("confidence"), "unit_id").limit(qa_sample)
    parts.append(sure.withColumns(
        {"item_type": F.lit("unit"), "unit_ids": F.array("unit_id"), "reasons": strings("high_confidence_sample"), "difficulty": F.lit("easy"), "goal": F.lit("validate"), "priority": F.lit(2), "review_item_id": hash_id("review_", "unit", F.col("unit_id"), "high_confidence_sample")}
    ).select(*shape))
    if minimal_pairs is not None:
        parts.append(minimal_pairs.select(
            F.lit("minimal_pair").alias("item_type"), strings().alias("unit_ids"), strings("minimal_pair").alias("reasons"), F.lit("hard").alias("difficulty"), F.lit("resolve_confusion").alias("goal"),
            F.concat_ws("\n", "text_a", "text_b").alias("text"), strings().alias("context_before"), strings().alias("context_after"), F.lit(3).alias("priority"), hash_id("review_", "minimal_pair", F.col("pair_id")).alias("review_item_id"),
        ))
    every = reduce(DataFrame.unionByName, parts)
    first = Window.partitionBy("review_item_id").orderBy("priority", F.col("unit_ids").cast("string"))
    return every.withColumn("rank", F.row_number().over(first)).where("rank = 1").drop("rank", "priority")


def review_manifest(items: DataFrame) -> DataFrame:
    """item_type, difficulty, goal and n."""
    return items.groupBy("item_type", "difficulty", "goal").agg(F.count(F.lit(1)).alias("n"))


def adjudication_reasons(units: DataFrame) -> DataFrame:
    """Units with ``risks``, the reasons to ask a stronger model; none means that the unit is left alone.

    Needs locked_functions and _conflicted where those reasons should count.
    """
    flags = F.transform("validator_flags", lambda f: f["rule_id"])
    locked = F.col("locked_functions") if "locked_functions" in units.columns else strings()
    near = F.col("_conflicted") if "_conflicted" in units.columns else F.lit(False)
    confusable = sorted({c for g in L.ADJUDICATION_CONFUSION_GROUPS for c in g})
    tests = [F.when(F.col("confidence") < L.ADJUDICATE_BELOW, F.lit("low_confidence"))]
    tests += [F.when(F.array_contains(flags, r), F.lit(r)) for r in sorted(L.HIGH_RISK_FLAGS)]
    tests += [
        F.when(F.col("emotion_intensity") >= L.ADJUDICATE_INTENSITY, F.lit("high_emotion_intensity")),
        F.when(F.size(F.array_except(locked, F.col("functions"))) > 0, F.lit("locked_heuristic_llm_conflict")),
        F.when(F.size("functions") > L.ADJUDICATE_FUNCTIONS, F.lit("too_many_functions")),
        F.when(F.col("primary_function").isin(*confusable), F.lit("confusable_primary_function")),
        F.when(near, F.lit("high_similarity_conflict")),
    ]
    return units.withColumn("risks", F.filter(F.array(*tests), lambda r: r.isNotNull()))


def decision_counts(votes: DataFrame) -> DataFrame:
    """review_item_id, decision, n and first (its earliest position) of votes(review_item_id, position, decision, confidence)."""
    return votes.groupBy("review_item_id", "decision").agg(F.count(F.lit(1)).alias("n"), F.min("position").alias("first"))


def committee_vote(votes: DataFrame) -> DataFrame:
    """Per item the most frequent decision (the earliest among equals), agreement, mean confidence and the committee's decision.

    Below either gate the committee asks for review. A vote's weight is one, so
    two of three fall short of the gate of 0.67.
    """
    top = decision_counts(votes).groupBy("review_item_id").agg(F.min(F.struct((-F.col("n")).alias("n"), "first", "decision")).alias("t"))
    sums = votes.groupBy("review_item_id").agg(F.count(F.lit(1)).alias("n_votes"), F.avg("confidence").alias("mean"))
    both = sums.join(top, "review_item_id").withColumn("agreement", -F.col("t.n") / F.col("n_votes"))
    unsure = (F.col("agreement") < L.AGREEMENT_GATE) | (F.col("mean") < L.CONFIDENCE_GATE)
    return both.select(
        "review_item_id",
        "n_votes",
        F.col("t.decision").alias("top_decision"),
        F.round("agreement", 4).alias("agreement"),
        F.when(unsure, "needs_review").otherwise(F.col("t.decision")).alias("aggregate_decision"),
        F.round(F.least("agreement", "mean"), 4).alias("confidence"),
        (F.when(unsure, F.lit("needs_review")).otherwise(F.col("t.decision")) != "needs_review").alias("needs_final_adjudication"),
    )


def fallback_finals(aggregated: DataFrame) -> DataFrame:
    """Finals that promote nothing, for where no final judge can be asked."""
    return aggregated.select("review_item_id", F.lit("needs_review").alias("final_decision"), F.lit(None).cast("string").alias("gold_status"), F.least("confidence", F.lit(0.5)).alias("reliability_score"), F.lit(True).alias("needs_human_review"))


def gold_candidates(finals: DataFrame, run_id: str = "run_unknown") -> DataFrame:
    """Finals(…, unit_id, final_notation) fit for synthetic gold, with candidate_id."""
    fit = F.col("final_decision").isin("accept", "revise") & F.col("gold_status").isNotNull() & F.col("unit_id").isNotNull() & ~F.col("needs_human_review") & (F.col("reliability_score") >= L.PROMOTION_FLOOR)
    return finals.where(fit).withColumn("candidate_id", hash_id("synthetic_candidate_", run_id, F.col("review_item_id"), F.col("unit_id"), F.col("final_notation"))).withColumnRenamed("gold_status", "status")


def adjudicator_agreement(aggregated: DataFrame, finals: DataFrame) -> DataFrame:
    """One row: comparable items, those on which committee and final judge agree, and their ratio."""
    both = aggregated.where("aggregate_decision <> 'needs_review'").join(finals.select("review_item_id", "final_decision"), "review_item_id")
    one = both.agg(F.count(F.lit(1)).alias("comparable"), F.count_if(F.col("final_decision") == F.col("aggregate_decision")).alias("agreed"))
    return one.withColumn("adjudicator_agreement", ratio(F.col("agreed"), F.col("comparable")))


def gold_status_counts(finals: DataFrame, candidates: DataFrame) -> DataFrame:
    """status and n, one status an item: the final judge's, else the candidate's."""
    own = finals.where("gold_status IS NOT NULL").select("review_item_id", F.col("gold_status").alias("f"))
    other = candidates.groupBy("review_item_id").agg(F.min("status").alias("c"))
    return own.join(other, "review_item_id", "full").select(F.coalesce("f", "c").alias("status")).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def reliability_metrics(votes: DataFrame, aggregated: DataFrame, finals: DataFrame, candidates: DataFrame, n_items: int) -> DataFrame:
    """One row of counts, agreement and mean confidences."""
    per_item = decision_counts(votes).groupBy("review_item_id").agg(F.round(F.max("n") / F.sum("n"), 4).alias("a"))
    mean = lambda c: F.coalesce(F.round(F.avg(c), 4), F.lit(0.0))
    rows = [
        per_item.agg(mean("a").alias("inter_reviewer_agreement")),
        votes.agg(F.count(F.lit(1)).alias("reviewer_output_count"), mean("confidence").alias("average_reviewer_confidence")),
        aggregated.agg(F.count(F.lit(1)).alias("aggregated_review_count"), mean("confidence").alias("average_aggregate_confidence")),
        finals.agg(F.count(F.lit(1)).alias("final_adjudication_count"), mean("reliability_score").alias("average_final_reliability"), F.count_if(F.col("final_decision") == "needs_review").alias("needs_review_count"), F.count_if("needs_human_review").alias("needs_human_review_count")),
        adjudicator_agreement(aggregated, finals).select("adjudicator_agreement"),
        candidates.agg(F.count(F.lit(1)).alias("synthetic_gold_candidate_count")),
        regression_eligible(candidates).agg(F.count(F.lit(1)).alias("regression_eligible_count")),
    ]
    one = reduce(DataFrame.crossJoin, rows)  # one row each
    return one.withColumns({"total_review_items": F.lit(n_items), "regression_eligible_rate": ratio(F.col("regression_eligible_count"), F.lit(n_items))})


def regression_eligible(candidates: DataFrame) -> DataFrame:
    own = candidates.where((F.col("status") == "synthetic_gold_high_confidence") & (F.col("reliability_score") >= L.REGRESSION_FLOOR))
    for name, clean in (("needs_review", lambda: ~F.col("needs_review")), ("validator_flags", lambda: F.size("validator_flags") == 0)):
        own = own.where(clean()) if name in own.columns else own
    return own


def gold_buckets(candidates: DataFrame) -> DataFrame:
    """Candidates with ``bucket``: high, medium or rejected."""
    kind = F.when(F.col("status") == "synthetic_gold_high_confidence", "high").when(F.col("status") == "synthetic_gold_medium_confidence", "medium").otherwise("rejected")
    return candidates.withColumn("bucket", kind)
