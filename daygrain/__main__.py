"""``spark-submit`` entry: all analyses from raw CSV folders to result tables."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from daygrain.plans import Scope, run


def main() -> None:
    parser = argparse.ArgumentParser(prog="daygrain", description=__doc__)
    parser.add_argument("--weather", required=True, help="hourly weather CSV file or folder")
    parser.add_argument("--collisions", required=True, help="collision CSV file or folder")
    parser.add_argument("--ridership", required=True, help="daily ridership CSV file or folder")
    parser.add_argument("--out", required=True, help="folder for tables and results")
    parser.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    parser.add_argument("--mode", default="errorifexists", choices=["errorifexists", "overwrite"])
    parser.add_argument("--first", default=Scope.first, help="first day of the rides and the code calendar")
    parser.add_argument("--last", default=Scope.last, help="last day of them")
    parser.add_argument("--station", default=Scope.station, help="station of the day tables, or 'all'")
    parser.add_argument("--split", default=Scope.split, choices=["day", "random"])
    parser.add_argument("--seed", type=int, default=Scope.seed, help="seed of the split")
    parser.add_argument("--events-by-month", action="store_true", help="a folder per month for the events")
    parser.add_argument("--resume", action="store_true", help="go on after a run that was stopped")
    args = parser.parse_args()
    station = None if args.station == "all" else args.station
    scope = Scope(args.first, args.last, station, args.split, args.seed)
    spark = SparkSession.builder.appName("daygrain").getOrCreate()
    names = run(
        spark, args.weather, args.collisions, args.ridership, args.out, args.format, args.mode,
        args.events_by_month, scope, args.resume,
    )
    for name in names:
        print(name)


if __name__ == "__main__":
    main()
