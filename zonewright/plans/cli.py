"""Command line: ``python -m zonewright.plans.cli <command>``."""

from __future__ import annotations

import argparse
import json
import logging
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .. import storage
from ..session import cluster_session
from ..sinks import files
from ..sources import generators, lists
from . import pipeline


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="zonewright")
    sub = p.add_subparsers(dest="command", required=True)
    a = sub.add_parser("aggregate-lists", help="one list from a directory of list files")
    a.add_argument("--input-dir", required=True)
    a.add_argument("--output", required=True)
    a.add_argument("--report")
    a.add_argument("--target-size", type=int, default=15_000_000)
    a.add_argument("--seed", type=int, default=42)
    a.add_argument("--delimiter")
    a.add_argument("--domain-column")
    a.add_argument("--no-header-auto-detect", action="store_true")
    a.add_argument("--strictness", choices=("lenient", "balanced", "strict"), default="balanced")
    a.add_argument("--deduplicate-per-file", action="store_true")
    a.add_argument("--deduplicate", action="store_true")
    a.add_argument("--shortfall", choices=("refill", "allow", "error"), default="refill")
    a.add_argument("--count-cache", help="Parquet table of row counts of files, used again while a file stays as it is")
    b = sub.add_parser("build-dataset", help="the balanced data set with its features")
    b.add_argument("--listed", required=True)
    b.add_argument("--generated", required=True)
    b.add_argument("--output", required=True)
    b.add_argument("--seed", type=int, default=42)
    b.add_argument("--train", type=float, default=0.8)
    b.add_argument("--validation", type=float, default=0.1)
    b.add_argument("--test", type=float, default=0.1)
    b.add_argument("--sample-size", type=int, default=1000)
    b.add_argument("--audit-size", type=int, default=100)
    b.add_argument("--part-bytes", type=int, default=1_900_000_000, help="size of a file by estimate, without splits")
    b.add_argument("--overwrite", action="store_true")
    b.add_argument("--no-splits", action="store_true")
    g = sub.add_parser("generate", help="fill a store of names from a directory of trusted generators")
    g.add_argument("--root", required=True, help="one directory a generator; its code is run")
    g.add_argument("--store", required=True, help="names and state; a store that is there is gone on with")
    g.add_argument("--output", help="folder for names.csv, plan.json and stats.json")
    g.add_argument("--config", help="JSON of option values; options given here go before it")
    g.add_argument("--target-count", type=int, default=15_000_000)
    g.add_argument("--per-source-cap", type=int, default=200_000)
    g.add_argument("--ordered-sources", help="codes by comma: only these, strictly in this order, each up to the cap")
    g.add_argument("--batch-size", type=int, default=5000)
    g.add_argument("--patience", type=int, default=4, help="batches without a new name after which a source ends")
    g.add_argument("--max-errors", type=int, default=5, help="batches of errors only after which a source ends")
    g.add_argument("--seed-strategy", choices=("sequential", "hashed_round_robin", "fixed"), default="sequential")
    g.add_argument("--date-strategy", choices=("daily_forward", "daily_window", "monthly_window", "fixed"), default="daily_forward")
    g.add_argument("--base-seed", type=int, default=0)
    g.add_argument("--base-date", default="2024-01-01")
    g.add_argument("--date-start", default="2018-01-01")
    g.add_argument("--date-end", default="2030-12-31")
    g.add_argument("--date-wrap-policy", choices=("clamp", "wrap", "reset-cycle"), default="clamp")
    g.add_argument("--heartbeat-seconds", type=float, default=15)
    g.add_argument("--dry-run", action="store_true", help="plan and a small sample only")
    g.add_argument("--validate-only", action="store_true", help="count the names of the store, generate none")
    v = sub.add_parser("validate-dataset", help="check a data set against its manifest")
    v.add_argument("--input", required=True)
    i = sub.add_parser("inspect-generators", help="what the directories of generators tell")
    i.add_argument("--root", required=True)
    return p


def with_config(p: argparse.ArgumentParser, argv: list[str]) -> argparse.Namespace:
    """Arguments, with the values of ``--config`` for those that were not given. Unknown names are an error."""
    args = p.parse_args(argv)
    if not getattr(args, "config", None):
        return args
    told = files.read_json(cluster_session(), args.config)
    if unknown := set(told) - set(vars(args)):
        raise ValueError(f"unknown options in {args.config}: {sorted(unknown)}")
    given = {a.split("=", 1)[0].lstrip("-").replace("-", "_") for a in argv if a.startswith("--")}
    for name, value in told.items():
        if name not in given:
            setattr(args, name, value)
    return args


def _generate(spark: SparkSession, args: argparse.Namespace) -> int:
    axes = generators.Axes(args.seed_strategy, args.date_strategy, args.base_seed, args.base_date, args.date_start, args.date_end, args.date_wrap_policy)
    ordered = [c.strip().lower() for c in (args.ordered_sources or "").split(",") if c.strip()]
    plan = generators.plan_run(generators.discover(args.root), args.target_count, args.per_source_cap, ordered)
    sources = [generators.source_of(p.found, p.cap, axes) for p in plan if p.found is not None and p.cap > 0]
    run = generators.Run(spark, args.store, sources, args.batch_size, args.patience, bool(ordered), args.max_errors, args.heartbeat_seconds)
    if args.validate_only:
        held = run.names().count()
        print(f"{held} of {args.target_count} names")
        return int(held != args.target_count)
    wanted = min(args.target_count, max(20_000, 250 * len(sources))) if args.dry_run else args.target_count
    run.run(target=wanted)
    told = run.report(plan, wanted)
    if args.output:
        if not args.dry_run:
            files.write_csv(run.names().select(F.struct("epoch", "seq", "domain").alias("at"), "domain", "algorithm_code"), storage.join(args.output, "names.csv"), "at", "overwrite")
        files.write_json(spark, {"sources": [p.told() for p in plan]}, storage.join(args.output, "plan.json"))
        files.write_json(spark, told, storage.join(args.output, "stats.json"))
    if errors := run.errors():
        raise ValueError("; ".join(errors))
    print(json.dumps(told, sort_keys=True))
    return 0 if ordered or told["held"] >= wanted else 1


def main(argv: list[str] | None = None) -> int:
    """0 if all went well, 1 if an input or a check failed."""
    logging.basicConfig(level=logging.INFO)
    try:
        args = with_config(parser(), sys.argv[1:] if argv is None else argv)
        if args.command == "inspect-generators":
            print(json.dumps([vars(f) for f in generators.discover(args.root)], indent=2))
            return 0
        spark = cluster_session()
        if args.command == "generate":
            return _generate(spark, args)
        if args.command == "aggregate-lists":
            opt = pipeline.ListOptions(
                args.target_size, args.seed, args.delimiter, args.domain_column, not args.no_header_auto_detect, args.strictness,
                args.deduplicate_per_file, args.deduplicate, args.shortfall, args.count_cache,
            )
            names, report = pipeline.aggregate_lists(spark, lists.discover(spark, args.input_dir), opt)
            files.write_csv(names, args.output)
            if args.report:
                files.write_json(spark, report, args.report)
            return 0
        if args.command == "build-dataset":
            opt = pipeline.DatasetOptions(
                args.seed, args.train, args.validation, args.test, args.part_bytes, args.sample_size, args.audit_size, args.overwrite, not args.no_splits
            )
            pipeline.build_dataset(spark, args.listed, args.generated, args.output, opt)
            return 0
        errors = pipeline.validate_dataset(spark, args.input)
        print("\n".join(errors) or "valid")
        return int(bool(errors))
    except (OSError, ValueError, KeyError) as e:
        print(f"error: {e}", file=sys.stderr)
        return 1


if __name__ == "__main__":
    sys.exit(main())
