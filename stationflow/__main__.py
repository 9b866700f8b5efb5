"""The jobs as commands for ``spark-submit`` or ``python -m stationflow``.

    plan-fetch   --prefix P --suffix S --have 'zips/*.zip' --first 2024-01-01 --last 2024-06-30 --out plan/
    unpack       --archives 'zips/*.zip' --raw raw/
    load-history --raw 'raw/JC-*.csv' --store store/
    load-recent  --raw 'raw/JC-*.csv' --store store/ [--files 2]
    train        --store store/ --models models/ [--stations a,b,c | --everywhere] [--trees 100]
    infer        --store store/ --models models/ [--stations a,b,c | --everywhere]

``--everywhere`` fits, or uses, models of all stations, which are one table below ``models/table``.
    reports      --store store/ --out reports/
"""

from __future__ import annotations

import argparse
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from stationflow.config import DEFAULTS
from stationflow.models.registry import ModelRegistry
from stationflow.models.tables import ModelTables
from stationflow.models.trees import TreeParams
from stationflow.plans import jobs
from stationflow.session import prepare
from stationflow.sources.archives import extract_archives
from stationflow.sources.calendar import fetch_plan
from stationflow.sources.store import TableStore
from stationflow.sources.trip_csv import export_csv, scan_newest_trips, scan_trips


def arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="stationflow")
    commands = parser.add_subparsers(dest="command", required=True)
    needs = {
        "plan-fetch": ("prefix", "suffix", "have", "first", "last", "out"),
        "unpack": ("archives", "raw"),
        "load-history": ("raw", "store"),
        "load-recent": ("raw", "store"),
        "train": ("store", "models"),
        "infer": ("store", "models"),
        "reports": ("store", "out"),
    }
    for name, options in needs.items():
        command = commands.add_parser(name)
        for option in options:
            command.add_argument(f"--{option}", required=True)
        if name == "load-recent":
            command.add_argument("--files", type=int, default=DEFAULTS.recent_files)
        if name in ("train", "infer"):
            command.add_argument("--stations", default=",".join(DEFAULTS.stations))
            command.add_argument("--everywhere", action="store_true")
        if name == "train":
            command.add_argument("--trees", type=int, default=TreeParams().trees)
    return parser.parse_args()


def main() -> None:
    args = arguments()
    spark = prepare(SparkSession.builder.appName(f"stationflow {args.command}").getOrCreate())
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    if args.command == "plan-fetch":
        plan = fetch_plan(spark, args.prefix, args.suffix, args.have, args.first, args.last)
        export_csv(plan, args.out)
        plan.orderBy("month").show(1000, truncate=False)
        return
    if args.command == "unpack":
        extract_archives(spark, args.archives, args.raw).where("error IS NOT NULL").show(truncate=False)
        return
    store = TableStore(spark, args.store)
    if args.command in ("load-history", "load-recent"):
        history = args.command == "load-history"
        scan = scan_trips(spark, args.raw) if history else scan_newest_trips(spark, args.raw, args.files)
        jobs.keep_rejects(store, scan, f"{args.command} {now:%Y-%m-%d %H-%M-%S-%f}")
        if history:
            jobs.load_history(store, scan.rows)
        else:
            print("new rows appended" if jobs.load_recent(store, scan.rows) else "no new rows")
    elif args.command == "reports":
        jobs.write_reports(store, args.out, now)
    else:
        registry, stations = ModelRegistry(spark, args.models), args.stations.split(",")
        tables = ModelTables(spark, f"{args.models}/table")
        if args.command == "train":
            jobs.train_naive(store, now, registry)
        if args.everywhere:
            if args.command == "train":
                jobs.train_everywhere(store, tables, now, TreeParams(trees=args.trees))
            else:
                jobs.infer_everywhere(store, tables)
        elif args.command == "train":
            jobs.train(store, registry, now, stations, TreeParams(trees=args.trees))
        else:
            jobs.infer(store, registry, stations)


if __name__ == "__main__":
    main()
