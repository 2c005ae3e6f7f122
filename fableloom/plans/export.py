"""A run's tables as files for others: JSON lines, CSV, notation text and reports."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import lexicon as L
from ..operators.validate import versions
from ..sources import sinks
from ..sources.versions import RunTables

#: The columns of the CSV files, in order.
UNIT_COLUMNS = ("document_id", "unit_id", "sequence_index", "text", "functions", "primary_function", "final_notation", "confidence", "method", "needs_review", "review_status", "taxonomy_version", "prompt_version", "validator_version")
RELATION_COLUMNS = ("run_id", "document_id", "relation_id", "source_unit_id", "target_unit_id", "relation_type", "confidence", "method", "needs_review", "taxonomy_version_effective", "prompt_version_effective", "validator_version_effective")
CHAIN_COLUMNS = ("run_id", "document_id", "chain_id", "chain_type", "unit_ids", "relation_ids", "notation_sequence", "score", "needs_review", "taxonomy_version_effective", "prompt_version_effective", "validator_version_effective")
#: One-row tables of a run that are reports.
REPORTS = ("evaluation", "reliability", "similarity_summary", "audit_summary")


def unit_csv(units: DataFrame) -> DataFrame:
    return sinks.csv_columns(units.withColumns({f"{n}_version": F.lit(L.VERSION) for n in ("taxonomy", "prompt", "validator")}).select(*UNIT_COLUMNS))


def relation_csv(relations: DataFrame) -> DataFrame:
    return sinks.csv_columns(relations.select(*RELATION_COLUMNS))


def chain_csv(chains: DataFrame) -> DataFrame:
    return sinks.csv_columns(chains.select(*CHAIN_COLUMNS))


def audit_summary(audit: DataFrame, units: DataFrame, run_id: str) -> DataFrame:
    """One row: units, flags and flags by severity, of audit(rule_id, severity, n)."""
    of = lambda s: F.coalesce(F.sum(F.when(F.col("severity") == s, F.col("n"))), F.lit(0)).alias(f"{s}s")
    sums = audit.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_flags"), of("error"), of("warning"), of("info"))
    return sums.select(F.lit(run_id).alias("run_id"), F.lit(units.count()).alias("total_units"), "*", *versions())


def export_run(spark: SparkSession, run_dir: str) -> list[str]:
    """Write the files of a run's latest commit below ``exports`` and name them.

    Tables become folders of part files, written by all executors; a document's
    units stand in one line of documents.jsonl, as that contract asks. Reports are
    one row each and become one JSON and one Markdown file. A second export
    replaces the first.
    """
    tables = RunTables(spark, run_dir)
    to = f"{tables.run_dir}/exports"
    documents, units, relations, chains = (tables.read(n) for n in ("documents", "units", "relations", "chains"))
    made = []
    for name, frame in (("documents", sinks.nested_documents(documents, units)), ("units", units), ("relations", relations), ("chains", chains)):
        sinks.write_jsonl(frame, f"{to}/{name}.jsonl")
        made.append(f"{name}.jsonl")
    for name, frame in (("units", unit_csv(units)), ("relations", relation_csv(relations)), ("chains", chain_csv(chains))):
        frame.write.mode("overwrite").option("header", True).csv(f"{to}/{name}.csv")
        made.append(f"{name}.csv")
    sinks.write_notation(units, f"{to}/notation")
    made.append("notation")
    for name in REPORTS:
        if name in tables.manifest["tables"]:
            row = tables.read(name)
            tables.put_text(f"exports/{name}.json", json.dumps(row.first().asDict(recursive=True), ensure_ascii=False, indent=2, sort_keys=True, default=str))
            tables.put_text(f"exports/{name}.md", sinks.markdown_report(row, name.replace("_", " ").capitalize()))
            made += [f"{name}.json", f"{name}.md"]
    tables.put_text("exports/run_manifest.json", json.dumps(tables.manifest, ensure_ascii=False, indent=2, sort_keys=True))
    return [*made, "run_manifest.json"]
