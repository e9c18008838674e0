"""Command line, for ``spark-submit`` or ``python -m martweave``.

    ingest --raw ROOT --load-id ID --source crm.users=PATH [--source ...]
    build  --raw ROOT --marts ROOT [--environment prod] [--schema analytics]

A failed load gives exit code 1; a failed test, or a raw table that was never loaded,
stops the build.
The pseudonymisation salt is read from the environment.
"""

from __future__ import annotations

import argparse
import sys
from datetime import date, datetime, timedelta, timezone

from martweave.functions.audit import Run
from martweave.functions.privacy import salt_column, salt_from_env
from martweave.operators.ingest import VolumeRule
from martweave.operators.staging import HORIZON
from martweave.plans.build import Inputs, build
from martweave.plans.ingest_run import has_failed, landed, run_ingest
from martweave.session import session
from martweave.sources.landing import BACKFILL_START, LANDINGS, Registry


def _utc(text: str) -> datetime:
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


def _source(text: str) -> tuple[tuple[str, str], str]:
    name, _, path = text.partition("=")
    source, _, table = name.partition(".")
    if not path or LANDINGS.get(table) is None or LANDINGS[table].source != source:
        raise argparse.ArgumentTypeError(f"not a known source.table=path: {text}")
    return (source, table), path


def parse(arguments: list[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="martweave")
    commands = parser.add_subparsers(dest="command", required=True)
    take = commands.add_parser("ingest")
    take.add_argument("--raw", required=True)
    take.add_argument("--load-id", required=True)
    take.add_argument("--source", type=_source, action="append", required=True)
    take.add_argument("--format", default="parquet")
    take.add_argument("--first", type=_utc, default=BACKFILL_START)
    take.add_argument("--lookback-days", type=int, default=0)
    take.add_argument("--volume", choices=["off", "report", "fail"], default="report")
    make = commands.add_parser("build")
    make.add_argument("--raw", required=True)
    make.add_argument("--marts", required=True)
    make.add_argument("--environment", default="dev")
    make.add_argument("--schema", default="analytics")
    make.add_argument("--horizon", type=date.fromisoformat, default=HORIZON)
    make.add_argument("--run-id")
    return parser.parse_args(arguments)


def main(arguments: list[str]) -> int:
    options = parse(arguments)
    spark = session()
    if options.command == "ingest":
        registry = Registry(spark, dict(options.source), options.format)
        lookback = timedelta(days=options.lookback_days) if options.lookback_days else None
        volume = None if options.volume == "off" else VolumeRule(fail=options.volume == "fail")
        report = run_ingest(
            spark, registry.read, options.raw, options.load_id, options.first, lookback, volume=volume
        )
        report.show(truncate=False)
        return int(has_failed(report))

    def raw(table: str):
        stored = landed(spark, options.raw, LANDINGS[table])
        if stored.is_new():
            raise FileNotFoundError(f"nothing was ever loaded into {stored.root}")
        return stored.read()

    run = Run(options.run_id) if options.run_id else Run()
    salt = salt_column(spark, salt_from_env())
    built = build(
        Inputs(spark, raw, run, salt, options.horizon),
        options.marts,
        options.environment,
        options.schema,
        deferred_tests=True,
    )
    built.tests.show(100, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
