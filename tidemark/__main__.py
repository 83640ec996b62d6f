"""Command line: spark-submit or `python -m tidemark <command> ...`."""

from __future__ import annotations

import argparse
from datetime import date, datetime, timezone

from tidemark.plans import checks, loads, planning, steps, upkeep, views
from tidemark.plans.days import Period
from tidemark.session import build_session
from tidemark.sources.store import Store, export_csv, read_payloads
from tidemark.streaming.builds import run_stream_builds


def _warehouse(spark, root: str) -> dict:
    store = Store(spark, root)
    found = {name: store.read_all(name) for name in loads.LOADS}
    return {name: df for name, df in found.items() if df is not None}


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tidemark")
    commands = parser.add_subparsers(dest="command", required=True)

    command = commands.add_parser("parse", help="raw payloads to one bronze snapshot")
    command.add_argument("payloads")
    command.add_argument("endpoint", choices=sorted(steps.PARSERS))
    command.add_argument("bronze")

    command = commands.add_parser("plan", help="what to request today, from the ids listed now and yesterday's answers")
    command.add_argument("store")
    command.add_argument("name")
    command.add_argument("available", help="Parquet with the listed ids")
    command.add_argument("--key", default="id")
    command.add_argument("--answers", help="Parquet with key and has_data for what was asked last")
    command.add_argument("--today", type=date.fromisoformat, default=datetime.now(timezone.utc).date())
    command.add_argument("--rescan-days", type=int, default=planning.RESCAN_DAYS)
    command.add_argument("--request-ids", type=int, default=planning.REQUEST_IDS)

    command = commands.add_parser("transform", help="newest bronze snapshots to silver tables")
    command.add_argument("bronze")
    command.add_argument("silver")
    command.add_argument("--frequency", default="all", choices=["all", *steps.BUILD_GROUPS])
    command.add_argument("--force", action="store_true")

    command = commands.add_parser("stream", help="all bronze files that are new since the last call to silver tables")
    command.add_argument("bronze")
    command.add_argument("silver")
    command.add_argument("checkpoint")
    command.add_argument("--frequency", default="all", choices=["all", *steps.BUILD_GROUPS])
    command.add_argument("--archive", help="where files go once they are built")

    command = commands.add_parser("load", help="changed silver tables into the warehouse")
    command.add_argument("silver")
    command.add_argument("warehouse")
    command.add_argument("--frequency", default="all", choices=["all", *loads.FREQUENCIES])
    command.add_argument("--force", action="store_true")

    command = commands.add_parser("repair", help="fill the newest gaps of the exchange tables, from new loads")
    command.add_argument("warehouse")
    command.add_argument("--full", action="store_true", help="read the whole tables")

    command = commands.add_parser("check", help="violation counts of the data-quality checks")
    command.add_argument("warehouse")
    command.add_argument("--state", help="folder of carried counts: key and reference checks of new loads only")

    command = commands.add_parser("export", help="a warehouse table or view as CSV")
    command.add_argument("warehouse")
    command.add_argument("name")
    command.add_argument("target")
    command.add_argument("--since", type=datetime.fromisoformat, help="first snapshot time (UTC)")
    command.add_argument("--until", type=datetime.fromisoformat, help="snapshots before this time (UTC)")

    args = parser.parse_args(argv)
    spark = build_session()
    match args.command:
        case "parse":
            raw = read_payloads(spark, args.payloads)
            print(steps.parse_to_bronze(raw, args.endpoint, args.bronze, datetime.now(timezone.utc)))
        case "plan":
            answers = spark.read.parquet(args.answers) if args.answers else None
            available = spark.read.parquet(args.available)
            store = Store(spark, args.store)
            print(planning.plan_day(store, args.name, available, args.key, args.today, answers, args.rescan_days, args.request_ids))
        case "transform":
            print(steps.run_builds(spark, args.bronze, Store(spark, args.silver), args.frequency, args.force))
        case "stream":
            silver = Store(spark, args.silver)
            print(run_stream_builds(spark, args.bronze, silver, args.checkpoint, args.frequency, args.archive))
        case "load":
            groups = tuple(loads.FREQUENCIES) if args.frequency == "all" else (args.frequency,)
            print(loads.run_loads(Store(spark, args.silver), Store(spark, args.warehouse), groups, args.force))
        case "repair":
            print((loads if args.full else upkeep).run_repairs(Store(spark, args.warehouse)))
        case "check":
            if args.state:
                print(upkeep.run_checks(Store(spark, args.warehouse), Store(spark, args.state)))
            else:
                print(checks.summary(_warehouse(spark, args.warehouse)))
        case "export":
            tables = Period(Store(spark, args.warehouse), args.since, args.until)
            named = tables[args.name] if args.name in tables else views.view(args.name, tables, ordered=True)
            export_csv(named, args.target)


if __name__ == "__main__":
    main()
