"""Run one job from the command line.

``python -m stratamill.run lake.json daily --since 2024-03-01``, where
``lake.json`` holds the fields of :class:`stratamill.plans.jobs.Lake`.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
from collections.abc import Sequence

from pyspark.sql import SparkSession

from stratamill.plans import jobs
from stratamill.session import build_session

JOBS = ("ingest", "silver", "gold", "mart", "upkeep", "layout", "repair", "quality", "parity", "daily")


def arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Run one lake job.")
    parser.add_argument("lake", help="JSON file with the locations")
    parser.add_argument("job", choices=JOBS)
    parser.add_argument("--source", help="ingest: one source label instead of all")
    parser.add_argument("--since", type=dt.date.fromisoformat, help="silver, parity, daily: first ingest day to take")
    parser.add_argument("--everything", action="store_true", help="silver: all batches, merged before or not; gold: all months")
    parser.add_argument("--as-of", type=dt.date.fromisoformat, help="gold, daily: the reporting day")
    parser.add_argument("--no-gate", action="store_true", help="publish without checks")
    return parser.parse_args(argv)


def run(spark: SparkSession, lake: jobs.Lake, args: argparse.Namespace):
    """Run the job the arguments name; returns what it reports."""
    gate = not args.no_gate
    match args.job:
        case "ingest":
            sources = [args.source] if args.source else list(lake.raw)
            return {source: jobs.ingest_source(spark, lake, source) for source in sources}
        case "silver":
            return jobs.silver_job(spark, lake, since=args.since, everything=args.everything, gate=gate)
        case "gold":
            return jobs.gold_job(spark, lake, as_of=args.as_of, gate=gate, everything=args.everything)
        case "mart":
            return jobs.mart_job(spark, lake, gate=gate)
        case "upkeep":
            return jobs.upkeep_job(spark, lake)
        case "layout":
            return jobs.layout_job(spark, lake)
        case "repair":
            return jobs.repair_job(spark, lake)
        case "quality":
            return [row.asDict() for row in jobs.quality_job(spark, lake).collect()]
        case "parity":
            return jobs.parity_job(spark, lake, since=args.since).first().asDict()
        case "daily":
            return jobs.daily_run(spark, lake, since=args.since, as_of=args.as_of, gate=gate)


def main(argv: Sequence[str] | None = None) -> None:
    args = arguments(argv)
    with open(args.lake, encoding="utf-8") as file:
        lake = jobs.Lake(**json.load(file))
    print(run(build_session(f"lake-{args.job}"), lake, args))


if __name__ == "__main__":
    main()
