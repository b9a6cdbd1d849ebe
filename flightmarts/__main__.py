"""Command line: load landed payloads, build the marts, check them.

    python -m flightmarts load  --landing L --bronze B [--airports ARN,GOT] [--backfill-days 3]
    python -m flightmarts build --bronze B --warehouse W
    python -m flightmarts refresh --bronze B --warehouse W --since 2026-01-24
    python -m flightmarts check --bronze B --warehouse W
"""

from __future__ import annotations

import argparse
import sys
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightmarts.plans import pipeline
from flightmarts.session import fit_shuffles, get_session
from flightmarts.sources import bronze
from flightmarts.sources.landing import airport_list, backfill_dates


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="flightmarts")
    parser.add_argument("--shuffle-partitions", type=int, help="fitted to the raw tables by default")
    commands = parser.add_subparsers(dest="command", required=True)

    load = commands.add_parser("load", help="append landed payloads to the raw tables")
    load.add_argument("--landing", required=True)
    load.add_argument("--bronze", required=True)
    load.add_argument("--airports", help="comma-separated codes; all by default")
    load.add_argument("--backfill-days", type=int, default=1)
    load.add_argument("--until", help="last day of the window, today by default")
    load.add_argument("--load-id", help="fixed-width, rising; seconds since 1970 by default")
    load.add_argument(
        "--replace", action="store_true", help="rewrite today's load of these airports and days"
    )
    load.add_argument(
        "--one-per-line", action="store_true", help="files hold a document per line and are split"
    )

    for name, text in [
        ("build", "rebuild all stored models"),
        ("refresh", "rebuild some days and what depends on them"),
        ("check", "report the quality checks; fails if one does"),
    ]:
        command = commands.add_parser(name, help=text)
        command.add_argument("--bronze", required=True)
        command.add_argument("--warehouse", required=True)
        command.add_argument("--as-of", help="day for the calendar's relative flags")
        if name == "refresh":
            command.add_argument("--since", required=True)
            command.add_argument("--until")
    return parser.parse_args(argv)


def show_all(report: DataFrame) -> None:
    """Prints every row; reports have a row per airport or check."""
    rows = report.collect()
    print(" | ".join(report.columns))
    for row in rows:
        print(" | ".join(str(value) for value in row))


def main(argv: list[str] | None = None) -> int:
    args = _arguments(argv)
    spark = get_session(shuffle_partitions=args.shuffle_partitions)
    if args.command == "load":
        now = time.time()
        summary = pipeline.load(
            spark,
            args.landing,
            args.bronze,
            load_id=args.load_id or str(int(now)),
            load_date=time.strftime("%Y-%m-%d", time.gmtime(now)),
            airports=airport_list(args.airports),
            dates=backfill_dates(args.backfill_days, args.until),
            replace=args.replace,
            one_per_line=args.one_per_line,
        )
        show_all(summary.orderBy("table_name", "airport"))
        return 0
    raw = pipeline.raw_tables(spark, args.bronze)
    if args.shuffle_partitions is None:
        read = raw
        if args.command == "refresh":
            until = args.until or args.since
            read = {t: bronze.in_days(rows, t, args.since, until) for t, rows in raw.items()}
        fit_shuffles(spark, *read.values())
    if args.command == "build":
        pipeline.build(spark, raw, args.warehouse, args.as_of)
        return 0
    if args.command == "refresh":
        pipeline.refresh(
            spark, raw, args.warehouse, args.since, args.until or args.since, args.as_of
        )
        return 0
    report = pipeline.check(spark, raw, args.warehouse)
    show_all(report.orderBy(F.desc("failing_rows"), "table_name", "column_name"))
    return 1 if report.filter("failing_rows > 0").head(1) else 0


if __name__ == "__main__":
    sys.exit(main())
