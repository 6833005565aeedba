"""Command line, ``python -m panelforge.cli``:

``panel BASE LEDGER OUT START END [--states SP,RJ] [--files N] [--quarantine FOLDER]`` replays a ledger into a panel,
``month BASE LANDING ROOT MONTH [--buckets N] [--multiline]`` detects a month's changes in all tables,
``export ROWS OUT [--order a,b] [--limit N]`` writes a table as CSV,
``months START END`` lists the months of a range.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from panelforge.functions.expr import month_range
from panelforge.plans.replay import reconstruct_panel
from panelforge.schemas import SPECS
from panelforge.sinks.files import write_csv, write_panel
from panelforge.sources.files import read_registry
from panelforge.streaming.monthly import DEDUP, RegistryMonths
from panelforge.streaming.snapshots import SnapshotMonths, registry_extras


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="panelforge")
    commands = parser.add_subparsers(dest="command", required=True)
    panel = commands.add_parser("panel", help="replay a ledger over baseline tables (parquet, one folder a table) into a panel")
    panel.add_argument("--states", default=None, help="comma-separated federal units of the output")
    panel.add_argument("--files", type=int, default=None, help="files a month; without it as many as their size asks for")
    panel.add_argument("--quarantine", default=None, help="folder with the quarantine so far; what is found is written beside OUT")
    month = commands.add_parser("month", help="detect a month's changes in the dump files of a landing folder, zipped or not, against baseline tables; folders named after other months are left out")
    month.add_argument("--buckets", type=int, default=None, help="keep states in so many hash buckets and commit all tables of a month as one; a ROOT is kept in one way")
    month.add_argument("--multiline", action="store_true", help="quoted fields may have line breaks")
    export = commands.add_parser("export", help="write a parquet table as CSV with a header")
    export.add_argument("--order", default=None, help="comma-separated columns to sort by")
    export.add_argument("--limit", type=int, default=None, help="most rows, the first of the order")
    months = commands.add_parser("months", help="list the months of a range")
    for command, names in ((panel, "base ledger out start end"), (month, "base landing root month"), (export, "rows out"), (months, "start end")):
        for name in names.split():
            command.add_argument(name)
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = _arguments(argv)
    if args.command == "months":
        print("\n".join(month_range(args.start, args.end)))
        return
    spark = SparkSession.builder.appName("panelforge").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if args.command == "panel":
        tables = {t: spark.read.parquet(f"{args.base}/{t}") for t in ("empresa", "estabelecimento", "socios", "simples", "munic")}
        ledger = {t: spark.read.parquet(f"{args.ledger}/{t}") for t in SPECS}
        logged = spark.read.parquet(args.quarantine) if args.quarantine else None
        rows, held = reconstruct_panel(spark, tables, ledger, args.start, args.end, args.states, logged)
        write_panel(rows, args.out, files_per_month=args.files)
        held.write.mode("overwrite").parquet(f"{args.out.rstrip('/')}-quarantine")
    elif args.command == "month":
        baseline, dumps = {t: spark.read.parquet(f"{args.base}/{t}") for t in SPECS}, read_registry(spark, args.landing, args.month, args.multiline)
        if args.buckets:
            job = SnapshotMonths(spark, args.root, SPECS, baseline, DEDUP, registry_extras, args.buckets)
            done = job.run(dumps, args.month)
            inserts, updates, deletes = map(sum, zip(*job.counts()[args.month].values(), strict=True))
        else:
            job = RegistryMonths(spark, args.root, baseline)
            done = job.run(dumps, args.month)
            inserts, updates, deletes = job.counts(args.month).select("inserts", "updates", "deletes").first()
        print(f"{args.month}: {inserts} inserted, {updates} updated, {deletes} deleted" + ("" if done else " (done before)"))
    else:
        write_csv(spark.read.parquet(args.rows), args.out, order=args.order.split(",") if args.order else None, limit=args.limit)


if __name__ == "__main__":
    main()
