"""Run a batch: ``spark-submit run_batch.py`` or ``python -m skytally``.

The scheduler passes the batch time, so that all steps of a run, and a repetition, mean the same hour.
"""

from __future__ import annotations

import argparse
import sys
from datetime import datetime

from pyspark.sql import SparkSession

from skytally.plans import batch
from skytally.session import configure


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="skytally")
    parser.add_argument("--root", required=True, help="where the zones are, any Hadoop path")
    parser.add_argument("--run-ts", type=datetime.fromisoformat, help="2024-03-05T06; not with --catch-up")
    parser.add_argument("--landing", help="folder of landed listing, details and dimensions")
    parser.add_argument("--catch-up", metavar="LANDING", help="dated landing folder: bring all open hours to gold")
    parser.add_argument("--flights", help="existing files of shaped flight records, instead of --landing")
    parser.add_argument("--airports", help="existing wrapped airports, with --flights")
    parser.add_argument("--airlines", help="existing wrapped airlines, with --flights")
    parser.add_argument(
        "--steps", nargs="+", choices=batch.STEPS, default=list(batch.STEPS), help="by default all"
    )
    given = parser.parse_args(argv)
    if (given.run_ts is None) == (given.catch_up is None):
        parser.error("give either --run-ts or --catch-up")
    return given


def main(argv: list[str] | None = None) -> int:
    given = _arguments(argv)
    spark = configure(SparkSession.builder.appName("skytally").getOrCreate())
    if given.catch_up:
        runs = batch.catch_up(spark, given.catch_up, given.root)
    else:
        existing = (given.flights, given.airports, given.airlines) if given.flights else None
        runs = [batch.run(spark, given.landing, given.root, given.run_ts, steps=given.steps, existing=existing)]
    for run in runs:
        for step in run.failed:
            print(f"failed: {run.run_ts:%Y-%m-%dT%H} {step}", file=sys.stderr)
        for table in run.missing:
            print(f"missing: {run.run_ts:%Y-%m-%dT%H} {table}", file=sys.stderr)
    return 1 if any(run.failed or run.missing for run in runs) else 0


if __name__ == "__main__":
    sys.exit(main())
