"""The builds as commands for spark-submit or ``python -m terrace``.

    land         --drop D --bronze B [--run-date YYYY-MM-DD] [--env dev]
    silver       --source S --bronze B --silver S [--run-date YYYY-MM-DD]
    incremental  --source S --bronze B --silver S --checkpoint C
    check        --source S --silver S [--snapshot latest|all|YYYY-MM-DD]
    gold         --silver S --gold G [--snapshot latest|all|YYYY-MM-DD] [--checked]
    register     --database D --zone Z [--merge-schema]

The run date is today in UTC if it is not given.  The exit status is 1 if a source
failed to land or a check failed.
"""

from __future__ import annotations

import argparse
import json
import sys
from collections.abc import Sequence

from pyspark.sql import SparkSession

from terrace.layout import utc_now
from terrace.operators.quality import run_suite
from terrace.plans.checks import SUITES, QualityFailure
from terrace.plans.gold import build_gold
from terrace.plans.silver import build_silver
from terrace.registry import landing_specs, lookup
from terrace.sources.catalog import register_zone
from terrace.sources.landing import land
from terrace.sources.manifests import write_manifest
from terrace.sources.silver import read_silver
from terrace.streaming import process_new_snapshots


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="terrace", description="Bronze, silver and gold builds.")
    commands = top.add_subparsers(dest="command", required=True)

    def command(name: str, required: str, **optional: str | None) -> argparse.ArgumentParser:
        one = commands.add_parser(name)
        for option in required.split():
            one.add_argument(f"--{option}", required=True)
        for option, default in optional.items():
            one.add_argument(f"--{option.replace('_', '-')}", default=default)
        return one

    today = utc_now()[:10]
    command("land", "drop bronze", run_date=today, env="dev")
    command("silver", "source bronze silver", run_date=today)
    command("incremental", "source bronze silver checkpoint")
    command("check", "source silver", snapshot="latest")
    command("gold", "silver gold", snapshot="latest").add_argument(
        "--checked", action="store_true"
    )
    command("register", "database zone").add_argument("--merge-schema", action="store_true")
    return top


def run(spark: SparkSession, args: argparse.Namespace) -> tuple[bool, object]:
    """Whether all went well, and what to print."""
    if args.command == "land":
        results = land(spark, landing_specs(), args.drop, args.bronze, args.run_date)
        write_manifest(results, args.bronze, args.run_date, utc_now(), args.env)
        rows = [r.asDict() for r in results.collect()]
        return all(r["status"] == "success" for r in rows), rows
    if args.command == "silver":
        done = build_silver(spark, args.source, args.run_date, args.bronze, args.silver)
        return True, vars(done)
    if args.command == "incremental":
        runs = process_new_snapshots(
            spark, args.source, args.bronze, args.silver, args.checkpoint
        )
        return True, [vars(r) for r in runs]
    if args.command == "check":
        source = lookup(args.source).name
        silver = read_silver(spark, args.silver, source, args.snapshot)
        result = run_suite(silver, source, SUITES[source])
        return result.passed, {"summary": result.summary(), "checks": result.checks}
    if args.command == "gold":
        suites = SUITES if args.checked else None
        try:
            built = build_gold(
                spark, args.silver, args.gold, snapshot=args.snapshot, suites=suites
            )
        except QualityFailure as failure:
            return False, str(failure)
        return True, built
    names = register_zone(spark, args.database, args.zone, merge_schema=args.merge_schema)
    return True, names


def main(argv: Sequence[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"terrace {args.command}").getOrCreate()
    good, printed = run(spark, args)
    print(json.dumps(printed, ensure_ascii=False))
    return 0 if good else 1


if __name__ == "__main__":
    sys.exit(main())
