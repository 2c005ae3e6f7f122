"""A run over a corpus: a folder of Parquet tables, made stage by stage and committed together."""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import lexicon as L
from ..operators import chains, embeddings, evaluate, heuristics, model_calls, relations, review, rollups, segment, similarity, validate
from ..sources.versions import RunTables
from . import export


def make_run_id(now: datetime | None = None) -> str:
    return (now or datetime.now(timezone.utc)).strftime("run_%Y%m%dT%H%M%SZ")


def run_corpus(docs: DataFrame, run_dir: str, run_id: str, transport: Callable[[str], str] | None = None, with_similarity: bool = False, limit: int | None = None, segments: DataFrame | None = None) -> dict[str, DataFrame]:
    """Units, relations, chains, sums of documents and, where asked for, similarity conflicts of docs(document_id, text), written under run_dir.

    segments(document_id, segment_index, text, start_ms, end_ms): documents that
    have some are cut along them. Without a model, units keep the default label and
    are not validated; with one, each unit is asked about once, its answer is kept
    in the run's llm_cache, and what is classified is written before the doubtful
    units are asked about again. limit takes the first documents by id. All
    tables appear together when the last is written; a run that is lost before
    leaves the folder as it was, but for answers of the model, which are kept.
    """
    spark = docs.sparkSession
    if limit is not None:
        docs = docs.orderBy("document_id").limit(limit)
    tables = RunTables(spark, run_dir)
    docs = tables.write(docs, "documents")
    if segments is None:
        units = segment.segment_texts(docs)
    else:
        own = segments.join(docs.select("document_id"), "document_id", "left_semi")
        rest = docs.join(segments.select("document_id").distinct(), "document_id", "left_anti")
        units = segment.segment_texts(rest).unionByName(segment.segment_timed(own), allowMissingColumns=True).withColumn("approximate_timing", F.coalesce("approximate_timing", F.lit(False)))
    units = segment.with_defaults(heuristics.annotate(units, normalise=False))
    if transport is not None:
        store = f"{run_dir}/llm_cache"
        classified = review.adjudication_reasons(tables.write(validate.validate(model_calls.classify(units, transport, store=store)), "classified"))
        units = validate.validate(model_calls.adjudicate(classified, transport, store=store).drop("risks"))
    units = tables.write(units, "units")
    out = detect_for_run(spark, run_dir, run_id, tables)
    if with_similarity:
        out["similarity_conflicts"] = audit_run(spark, run_dir, run_id, tables=tables)
    manifest = spark.createDataFrame([(run_id, datetime.now(timezone.utc), L.VERSION, L.VERSION, L.VERSION, json.dumps({"model": transport is not None, "similarity": with_similarity, "limit": limit}))], "run_id string, created_at_utc timestamp, taxonomy_version string, prompt_version string, validator_version string, options string")
    tables.write(manifest, "manifest")
    tables.commit(run_id=run_id, command="run")
    return {"documents": docs, "units": units, "manifest": manifest, **out}


def model_run(spark: SparkSession, run_dir: str, transport: Callable[[str], str], step: str) -> DataFrame:
    """A run's units classified by a model, or (step ``adjudicate``) the doubtful ones asked about again; relations and chains are found anew after that."""
    tables, store = RunTables(spark, run_dir), f"{run_dir}/llm_cache"
    if step == "classify":
        plain = segment.with_defaults(heuristics.annotate(tables.read("units"), normalise=False))
        units = validate.validate(model_calls.classify(plain, transport, store=store))
    else:
        units = validate.validate(model_calls.adjudicate(review.adjudication_reasons(tables.read("units")), transport, store=store).drop("risks"))
    out = tables.write(units, "units")
    detect_for_run(spark, run_dir, "run_unknown", tables)
    tables.commit(command=step)
    return out


def detect_for_run(spark: SparkSession, run_dir: str, run_id: str, tables: RunTables | None = None) -> dict[str, DataFrame]:
    """Relations, then chains, of a run's units, and sums of them for each document. tables: of a run that commits later itself."""
    own = tables or RunTables(spark, run_dir)
    units = own.read("units")
    found = own.write(relations.detect_relations(units, run_id), "relations")
    chained = own.write(chains.detect_chains(units, found, run_id), "chains")
    sums = own.write(rollups.document_rollups(units, found, chained), "document_rollups")
    if tables is None:
        own.commit(run_id=run_id, command="detect")
    return {"relations": found, "chains": chained, "document_rollups": sums}


def audit_run(spark: SparkSession, run_dir: str, run_id: str, threshold: float = L.SIMILARITY_THRESHOLD, top_k: int = L.SIMILARITY_TOP_K, config: dict | None = None, tables: RunTables | None = None) -> DataFrame:
    """Conflicts between units whose text, in its context, reads alike; neighbours are not compared.

    config: names the provider of vectors (see embeddings.vectors_from_config), by
    default local ones; those of others are kept in the run's table ``vectors``, so
    a second audit asks for none of them again. The summary is a table beside it.
    """
    own = tables or RunTables(spark, run_dir)
    units = own.read("units")
    texts = segment.with_neighbours(units.select("document_id", "sequence_index", "unit_id", "text"), 1, 1, lambda order: {"context": similarity.context_text(order, "text")})
    found = embeddings.vectors_from_config(config or {}, texts, "unit_id", "context", f"{run_dir}/vectors")
    placed = found.join(units.select("unit_id", "document_id", "sequence_index"), "unit_id")
    vectors = similarity.normalise_vectors(placed, "unit_id", "vector", F.col("document_id"), F.col("sequence_index"))
    pairs = similarity.similar_pairs(vectors, threshold, top_k, skip_neighbours=True)
    pairs = own.write(pairs, "similar_pairs")
    conflicts = own.write(similarity.conflicts(pairs, units, run_id), "similarity_conflicts")
    counted = F.struct(F.lit(run_id).alias("run_id"), F.lit(threshold).alias("threshold"), F.lit(top_k).alias("top_k"))
    sums = similarity.audit_summary(conflicts).select(counted.alias("c"), "*").select("c.*", "total_conflicts", "conflicts_by_type")
    own.write(sums.withColumns({"total_units": F.lit(units.count()), "total_pairs_considered": F.lit(pairs.count())}), "similarity_summary")
    if tables is None:
        own.commit(run_id=run_id, command="audit")
    return conflicts


CONFLICT = "conflict_id string, run_id string, unit_id_a string, unit_id_b string, similarity double, notation_distance double, conflict_score double, conflict_explanation_type string, explanation string, differing_fields array<string>, needs_review boolean"


def review_run(spark: SparkSession, run_dir: str) -> DataFrame:
    """The review set of a run."""
    tables = RunTables(spark, run_dir)
    units = tables.read("units")
    if "validator_flags" not in units.columns:
        units = units.withColumn("validator_flags", F.array().cast(segment.FLAGS))
    items = tables.write(review.build_review_set(units, tables.read("similarity_conflicts", CONFLICT)), "review_items")
    tables.commit(command="review")
    return items


def committee_run(spark: SparkSession, run_dir: str, reviewers: DataFrame, transport: Callable[[str], str], run_id: str = "run_unknown", max_items: int | None = None) -> dict[str, DataFrame]:
    """Votes, committee decisions, finals, candidates for gold and failures on a run's review items, the first max_items by id if given.

    Reviewers, then an aggregator, then a final judge are asked, each once for an
    item; where one has no usable answer, the rule stands that promotes nothing.
    """
    tables, store = RunTables(spark, run_dir), f"{run_dir}/llm_cache"
    items = tables.read("review_items")
    if max_items is not None:
        items = items.orderBy("review_item_id").limit(max_items)

    votes, failed_votes = model_calls.review_by_committee(items, reviewers, transport, store=store)
    votes = tables.write(votes, "votes")
    aggregated, failed_sums = model_calls.aggregate_by_model(items, votes, review.committee_vote(votes), transport, store=store)
    aggregated = tables.write(aggregated, "aggregated")
    finals, failed_finals = model_calls.final_by_model(items, aggregated, review.fallback_finals(aggregated), transport, store=store)
    finals = tables.write(finals, "finals")
    units = tables.read("units").select("unit_id", "final_notation")
    named = finals.join(items.select("review_item_id", F.get("unit_ids", F.lit(0)).alias("unit_id")), "review_item_id").join(units, "unit_id", "left")
    out = {
        "votes": votes,
        "aggregated": aggregated,
        "finals": finals,
        "gold_candidates": tables.write(review.gold_candidates(named, run_id), "gold_candidates"),
        "failures": tables.write(failed_votes.unionByName(failed_sums).unionByName(failed_finals), "failures"),
    }
    tables.commit(run_id=run_id, command="committee")
    return out


def evaluate_run(spark: SparkSession, run_dir: str, gold: DataFrame, run_id: str = "run_unknown") -> dict[str, DataFrame]:
    """Metrics, label metrics, confusions, audit counts and their sums of a validated run against gold units."""
    tables = RunTables(spark, run_dir)
    units = tables.read("units")
    found = {
        "evaluation": evaluate.run_metrics(units, gold, tables.read("similarity_conflicts", CONFLICT)),
        "label_metrics": evaluate.label_metrics(units, gold),
        "confusions": evaluate.confusions(units, gold),
        "audit": evaluate.audit_report(units, tables.read("relations"), tables.read("chains")),
    }
    out = {name: tables.write(frame, name) for name, frame in found.items()}
    out["audit_summary"] = tables.write(export.audit_summary(out["audit"], units, run_id), "audit_summary")
    tables.commit(run_id=run_id, command="evaluate")
    return out


def reliability_run(spark: SparkSession, run_dir: str) -> DataFrame:
    """One row of reliability metrics of a committee's run; candidates for gold are a table with their bucket beside it."""
    tables = RunTables(spark, run_dir)
    votes, aggregated, finals, candidates = (tables.read(n) for n in ("votes", "aggregated", "finals", "gold_candidates"))
    n = tables.read("review_items").count()
    found = tables.write(review.reliability_metrics(votes, aggregated, finals, candidates, n), "reliability")
    tables.write(review.gold_buckets(candidates), "gold_buckets")
    tables.commit(command="reliability")
    return found
