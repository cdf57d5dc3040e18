"""The command line: python -m gleaner COMMAND --input FOLDER --output FOLDER.

Every command runs its plan up to a stage and writes the tables up to there as files; generate and generate-deep run
all of it.  Replies of a model are kept in the output folder's llm_cache; without a model the rules do what they can.
"""

from __future__ import annotations

import argparse
from dataclasses import replace

from pyspark.sql import SparkSession

from gleaner import config
from gleaner.plans import deep, legacy
from gleaner.session import session
from gleaner.sources import files

#: Stages of the plan through concepts and facts, by the last table that a command writes.
STAGES = {
    "build-structure": "document_structure.json",
    "extract-concepts": "concepts.json",
    "extract-facts": "evidence.json",
    "build-graph": "concept_fact_graph.json",
    "analyze-combinations": "fact_combinations.json",
    "generate-qa": "qa_candidates.jsonl",
    "validate-qa": "qa_rejected.jsonl",
    "export-final": "dataset.final.jsonl",
}


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="gleaner", description="Question-answering datasets from Markdown and text files.")
    commands = out.add_subparsers(dest="command", required=True)
    for name in ("generate", "generate-deep", *STAGES):
        command = commands.add_parser(name)
        command.add_argument("--input", required=True)
        command.add_argument("--output", required=True)
        command.add_argument("--config")
        command.add_argument("--dry-run", action="store_true", help="never ask a model")
        if name.startswith("generate") and name not in STAGES:
            command.add_argument("--language")
            command.add_argument("--target-size", type=int)
            command.add_argument("--force", action="store_true", help="delete the files of the output folder first")
            command.add_argument("--resume", action="store_true", help="keep them even so")
    return out


def main(argv: list[str] | None = None, spark: SparkSession | None = None, call=None) -> dict[str, int]:
    """Runs a command; how many rows the tables have that it wrote. call: the model, if there is one."""
    args = parser().parse_args(argv)
    settings = config.load(args.config)
    if getattr(args, "target_size", None):
        settings = replace(settings, target_size=args.target_size)
    if getattr(args, "language", None):
        settings = replace(settings, language=args.language)
    spark = spark or session()
    if getattr(args, "force", False) and not args.resume:
        files.clear(spark, args.output)
    docs, errors = files.read_documents(spark, args.input, tuple(settings.file_types))
    cache = None if args.dry_run else f"{args.output.rstrip('/')}/llm_cache"
    plan = deep if args.command == "generate-deep" else legacy
    tables = plan.run(docs, settings, None if args.dry_run else call, cache_folder=cache).artifacts()
    if args.command in STAGES:
        names = list(tables)
        tables = {n: tables[n] for n in names[: names.index(STAGES[args.command]) + 1]}
    files.write_artifacts(tables, args.output)
    files.write_errors(errors, args.output)
    counts = {name: df.count() for name, df in tables.items()}
    print("Done " + " ".join(f"{name.split('.json')[0]}={n}" for name, n in counts.items()))
    return counts
