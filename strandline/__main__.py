"""Command line: run the register flow, verify its layers, pseudonymise deliveries.

    python -m strandline run --root R --inbox I --run-id ID [--at "2024-03-01 12:00:00"]
    python -m strandline verify --root R [--summary] [--key [K]] [--integrity] [--all]
    python -m strandline pseudonymise --source S --target T [--glob G] [--dry-run]

Exit status: 0 if all is well, 1 if a check failed, 2 if the layers are not there.
"""

from __future__ import annotations

import argparse
import sys
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from strandline.operators import quality
from strandline.plans import register
from strandline.session import build_session

ANY_KEY = ""


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="strandline")
    commands = top.add_subparsers(dest="command", required=True)

    run = commands.add_parser("run", help="take in all deliveries")
    run.add_argument("--root", required=True)
    run.add_argument("--inbox", required=True)
    run.add_argument("--run-id", required=True)
    run.add_argument("--at", type=datetime.fromisoformat)

    verify = commands.add_parser("verify", help="check the layers")
    verify.add_argument("--root", required=True)
    verify.add_argument("--summary", action="store_true")
    verify.add_argument("--key", nargs="?", const=ANY_KEY)
    verify.add_argument("--integrity", action="store_true")
    verify.add_argument("--all", action="store_true")

    names = commands.add_parser("pseudonymise", help="replace names in deliveries")
    names.add_argument("--source", required=True)
    names.add_argument("--target", required=True)
    names.add_argument("--glob", default="*.txt")
    names.add_argument("--dry-run", action="store_true")
    return top


def print_all(rows: DataFrame) -> None:
    """Every row of a report, a partition at a time, however many there are."""
    print("\t".join(rows.columns))
    for row in rows.toLocalIterator():
        print("\t".join("" if value is None else str(value) for value in row))


def do_run(spark: SparkSession, args: argparse.Namespace) -> int:
    layers = register.Layers(spark, args.root)
    at = args.at or datetime.now(timezone.utc).replace(tzinfo=None)
    outcomes = register.run(layers, args.inbox, args.run_id, at)
    for outcome in outcomes:
        print(f"{outcome.status:5} {outcome.name} ({outcome.failures})")
    return int(any(o.status == quality.FAILED for o in outcomes))


def do_verify(spark: SparkSession, args: argparse.Namespace) -> int:
    layers = register.Layers(spark, args.root)
    chosen = args.summary or args.integrity or args.key is not None
    everything = args.all or not chosen
    status = 0
    if args.summary or everything:
        print_all(register.summary(layers))
    if args.key is not None or everything:
        rows = register.lineage(layers, args.key or None)
        if rows is None:
            print("the history is empty")
        else:
            print_all(rows)
    if args.integrity or everything:
        # Shown and counted from one computation.
        problems = register.integrity(layers).persist()
        number = problems.count()
        status = 1 if number else 0
        if status:
            print(f"problems: {number}")
            print_all(problems)
        else:
            print("no issues detected")
        problems.unpersist()
    return status


def do_pseudonymise(spark: SparkSession, args: argparse.Namespace) -> int:
    report = register.pseudonymise_deliveries(
        spark, args.source, args.target, args.glob, args.dry_run
    )
    print_all(report)
    return 0


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    command = {"run": do_run, "verify": do_verify, "pseudonymise": do_pseudonymise}
    spark = build_session()
    try:
        return command[args.command](spark, args)
    except (AnalysisException, LookupError, FileNotFoundError) as error:
        print(error, file=sys.stderr)
        return 2


if __name__ == "__main__":
    sys.exit(main())
