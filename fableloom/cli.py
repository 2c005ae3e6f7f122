"""spark-submit entry: run, detect, audit, review and inspect a run folder."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .operators import evaluate
from .operators.embeddings import named_function
from .plans import export
from .plans import run as R
from .sources import sinks, transcripts
from .sources.versions import RunTables


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="fableloom")
    parser.add_argument("command", choices=["run", "detect", "audit", "review", "evaluate", "reliability", "inspect", "export", "drop-old", "classify", "adjudicate", "committee"])
    parser.add_argument("run_dir")
    parser.add_argument("--input", help="a text, JSON or JSONL transcript or a folder of them, for run; gold records as JSON lines, for evaluate; reviewers as JSON lines, for committee")
    parser.add_argument("--run-id")
    parser.add_argument("--limit", type=int)
    parser.add_argument("--similarity", action="store_true")
    parser.add_argument("--transport", help="package.module:function that takes a request and gives a reply, for run and the model's commands")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("fableloom").getOrCreate()
    run_id = args.run_id or R.make_run_id()
    if args.command == "run":
        docs, segments = transcripts.load_transcripts(spark, args.input, args.limit)
        R.run_corpus(docs, args.run_dir, run_id, named_function(args.transport) if args.transport else None, with_similarity=args.similarity, segments=segments)
    elif args.command == "detect":
        R.detect_for_run(spark, args.run_dir, run_id)
    elif args.command == "audit":
        R.audit_run(spark, args.run_dir, run_id)
    elif args.command == "review":
        R.review_run(spark, args.run_dir)
    elif args.command == "evaluate":
        gold = evaluate.read_gold(spark, args.input)
        found = R.evaluate_run(spark, args.run_dir, gold, run_id)
        print(sinks.markdown_report(found["evaluation"], f"Evaluation of {args.run_dir}"))
    elif args.command == "reliability":
        print(sinks.markdown_report(R.reliability_run(spark, args.run_dir), f"Reliability of {args.run_dir}"))
    elif args.command == "export":
        print("\n".join(export.export_run(spark, args.run_dir)))
    elif args.command == "drop-old":
        print(RunTables(spark, args.run_dir).drop_old(), "versions deleted")
    elif args.command in ("classify", "adjudicate", "committee"):
        if not args.transport:
            parser.error(f"{args.command} needs --transport")
        transport = named_function(args.transport)
        if args.command == "committee":
            reviewers = spark.read.schema("reviewer_id string, position int, profile string").json(args.input)
            R.committee_run(spark, args.run_dir, reviewers, transport, run_id, args.limit)
        else:
            R.model_run(spark, args.run_dir, transport, args.command)
    for name in ("documents", "units", "relations", "chains"):
        print(name, RunTables(spark, args.run_dir).read(name, "x int").count())


if __name__ == "__main__":
    main()
