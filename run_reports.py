"""Run all reports over a trip file and a zone file and save them as CSV.

    spark-submit run_reports.py --trips TRIPS --zones ZONES --out DIR --run-id ID
        --providers FIRST SECOND --time-of-day evening --origin A --destination B

Reports with a row for every trip are left out unless --row-tables names a folder,
to which they go whole, as parquet. On a cluster set spark.checkpoint.dir, which is
tried before the first report.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from tripmart.operators import with_calendar
from tripmart.plans import ROW_TABLES, Mart, Settings, catalog
from tripmart.session import configured
from tripmart.sources import (
    read_staged_trips,
    read_trips,
    read_zones,
    run_path,
    stage_trips,
    write_report,
)
from tripmart.storage import ensure_checkpoint_dir


def options(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--trips", required=True)
    parser.add_argument("--zones", required=True)
    parser.add_argument("--out", required=True)
    parser.add_argument("--run-id", required=True)
    parser.add_argument("--row-tables", help="parquet folder for the row-level tables")
    parser.add_argument("--year", action="store_true", help="keep the years apart")
    parser.add_argument("--stage", help="parquet folder for the typed trips")
    parser.add_argument("--mode", default="strict_split", help="strict_split or csv")
    parser.add_argument("--trip-header")
    parser.add_argument("--zone-header")
    parser.add_argument("--providers", nargs=2, required=True)
    parser.add_argument("--time-of-day", required=True)
    parser.add_argument("--origin", required=True)
    parser.add_argument("--destination", required=True)
    parser.add_argument("--long-wait", type=float, default=300)
    parser.add_argument("--sparse-below", type=int, default=1000)
    parser.add_argument("--only", nargs="*", help="names of the reports to run")
    return parser.parse_args(argv)


def run(spark: SparkSession, args: argparse.Namespace) -> list[str]:
    """Paths of the reports written."""
    ensure_checkpoint_dir(spark)
    spark.range(1).checkpoint()  # fails here, not after hours, if the folder is no good
    trips = read_trips(spark, args.trips, mode=args.mode, header=args.trip_header)
    zones = read_zones(spark, args.zones, mode=args.mode, header=args.zone_header)
    if args.stage:
        # the text is parsed once, all reports then read narrow columns of parquet
        stage_trips(with_calendar(trips, args.year), args.stage)
        trips = read_staged_trips(spark, args.stage)
    settings = Settings(
        provider=args.providers[0],
        shared={f"{p.lower()}_count": p for p in args.providers},
        time_of_day=args.time_of_day,
        origin=args.origin,
        destination=args.destination,
        long_wait=args.long_wait,
        sparse_below=args.sparse_below,
    )
    mart = Mart.of(trips, zones, year=args.year, share=True)
    paths = []
    for name, report in catalog(settings).items():
        if args.only and name not in args.only:
            continue
        if name not in ROW_TABLES:
            path = run_path(args.out, args.run_id, name)
            write_report(report(mart), path)
        elif args.row_tables:
            path = run_path(args.row_tables, args.run_id, name)
            report(mart).write.mode("overwrite").parquet(path)
        else:
            continue
        paths.append(path)
    mart.release()
    return paths


def main() -> None:
    spark = configured(SparkSession.builder.appName("tripmart-reports")).getOrCreate()
    for path in run(spark, options()):
        print(path)
    spark.stop()


if __name__ == "__main__":
    main()
