"""spark-submit entry point: ``python -m kerbside.cli run --source-file F --warehouse W``."""

from __future__ import annotations

import argparse
import logging
import sys
from datetime import date

from kerbside.plans import jobs
from kerbside.plans.verification import verify
from kerbside.session import build_session
from kerbside.sources.warehouse import Warehouse
from kerbside.streaming.incremental import ingest_and_refresh

# The commands and the options each takes besides --warehouse.
OPTIONS: dict[str, set[str]] = {
    "run": {"source_file", "extraction_date", "no_date_filter", "mode", "on_bad_date"},
    "bronze": {"source_file", "extraction_date", "no_date_filter", "mode", "on_bad_date"},
    "silver": {"extraction_month"},
    "gold": {"extraction_date", "by_month"},
    "incremental": {"source_file", "extraction_date", "mode", "on_bad_date"},
    "backfill": set(),
    "all-months": {"source_file", "mode", "on_bad_date"},
    "follow": {"source_file", "extraction_date", "on_bad_date", "progress_folder"},
    "verify": {"extraction_month"},
}


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="kerbside", description=__doc__)
    parser.add_argument("command", choices=list(OPTIONS))
    parser.add_argument("-s", "--source-file", help="booking file, folder or pattern; for follow, the folder files arrive in")
    parser.add_argument("-d", "--extraction-date", type=date.fromisoformat,
                        help="YYYY-MM-DD, default today; for gold, the one day of the daily summary")
    parser.add_argument("-m", "--extraction-month", help="YYYY-MM, limits silver and names the verified month")
    parser.add_argument("-w", "--warehouse", default="warehouse", help="root folder of the stored tables")
    parser.add_argument("--no-date-filter", action="store_true", help="load all rows, whatever their date")
    parser.add_argument("--by-month", action="store_true", help="for gold: one row per extraction month")
    parser.add_argument("--mode", choices=["replace", "append", "add_new"])
    parser.add_argument("--on-bad-date", choices=["reject", "fail"])
    parser.add_argument("--progress-folder", help="for follow: where the taken files are recorded")
    args = parser.parse_args(argv)
    allowed = OPTIONS[args.command]
    unused = [name for name, value in vars(args).items()
              if value not in (None, False) and name not in {"command", "warehouse"} | allowed]
    if unused:
        parser.error(f"{args.command} does not take --{unused[0].replace('_', '-')}")
    if "source_file" in allowed and not args.source_file:
        parser.error(f"{args.command} needs --source-file")
    if args.command == "verify" and not args.extraction_month:
        parser.error("verify needs --extraction-month")
    return args


def execute(args: argparse.Namespace, spark) -> dict[str, dict[str, int]]:
    """Run one command; rows written by layer and table."""
    warehouse = Warehouse(spark, args.warehouse)
    load = {"mode": args.mode or "replace", "on_bad_date": args.on_bad_date or "reject"}
    match args.command:
        case "run":
            return jobs.run(spark, args.warehouse, args.source_file, args.extraction_date,
                            no_date_filter=args.no_date_filter, **load)
        case "incremental":
            return jobs.incremental(spark, args.warehouse, args.source_file, args.extraction_date, **load)
        case "bronze":
            return jobs.run(spark, args.warehouse, args.source_file, args.extraction_date, run_silver=False,
                            run_gold=False, no_date_filter=args.no_date_filter, **load)
        case "silver":
            return {"silver": jobs.silver_refresh(warehouse, extraction_month=args.extraction_month)}
        case "gold":
            return {"gold": jobs.gold_refresh(warehouse, target_date=args.extraction_date, by_month=args.by_month)}
        case "backfill":
            return jobs.backfill(spark, args.warehouse)
        case "all-months":
            return jobs.run_all_months(spark, args.warehouse, args.source_file, **load)
        case "follow":
            progress = args.progress_folder or f"{args.warehouse}/progress"
            return ingest_and_refresh(spark, args.source_file, args.warehouse, progress,
                                      extraction_date=args.extraction_date, on_bad_date=load["on_bad_date"])
        case _:
            for name, frame in verify(warehouse, args.extraction_month).items():
                print(name)
                print(*frame.columns, sep="\t")
                for row in frame.toLocalIterator():  # a row per month at most
                    print(*row, sep="\t")
            return {}


def main(argv: list[str] | None = None) -> int:
    logging.basicConfig(level=logging.INFO)
    args = parse_args(argv)
    try:
        results = execute(args, build_session(f"kerbside-{args.command}"))
    except Exception:
        logging.exception("%s failed", args.command)
        return 1
    for layer, counts in results.items():
        for table, rows in counts.items():
            print(f"{layer:8} {table:32} {rows:>14,}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
