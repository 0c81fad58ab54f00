"""One refresh, for `spark-submit --py-files repopulse.zip repopulse/run.py --raw <folder>`.

Exits with an error if the refresh fails or a check of severity `error` finds something.
"""

from __future__ import annotations

import argparse
import datetime

from repopulse.plans.layers import raw_frames, register_raw
from repopulse.plans.refresh import refresh
from repopulse.session import cluster_session
from repopulse.sources import landing
from repopulse.sources.readers import read_all


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Build, check and publish the activity marts.")
    parser.add_argument("--raw", required=True, help="folder with the five raw tables")
    parser.add_argument("--format", choices=("parquet", "json"), default="parquet")
    parser.add_argument(
        "--landing", help="new folder to land JSON lines in as Parquet; lines that cannot be read are put aside there"
    )
    parser.add_argument("--times", choices=("timestamp", "string"), default="timestamp", help="as Parquet holds them")
    parser.add_argument("--objects", choices=("string", "variant"), default="string", help="as JSON objects are read")
    parser.add_argument("--as-of", help="last day of the trailing window, YYYY-MM-DD; today if not given")
    parser.add_argument("--layer", default="mart")
    parser.add_argument("--prefix", default="", help="put before the names of the marts")
    parser.add_argument("--staging", help="layer for the five staging views; none are made if not given")
    parser.add_argument("--raw-layer", default="raw", help="layer that the raw tables are registered in for them")
    parser.add_argument("--location", help="folder of the layer; the warehouse's own if not given")
    parser.add_argument("--keep", type=int, default=2, help="runs to keep at least")
    parser.add_argument("--hold-hours", type=float, default=24, help="how long a run stays readable after the next")
    parser.add_argument("--warn-only", action="store_true", help="publish whatever the checks find")
    parser.add_argument("--shuffle-gb", type=int, default=1024, help="expected shuffle volume, for its partitions")
    parser.add_argument("--cores", type=int, default=8, help="cores of the cluster")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = parse(argv)
    if args.landing and args.format != "json":
        raise SystemExit("--landing is for --format json")
    scan = "whole" if args.format == "json" else "narrow"
    spark = cluster_session(shuffle_bytes=args.shuffle_gb * 1024**3, cores=args.cores, scan=scan)
    found = []
    if args.landing:
        landed = landing.land(spark, args.raw, args.landing, times=args.times, objects=args.objects)
        raw, found = landed.raw, landed.checks
        if args.staging:
            register_raw(
                spark, args.landing, args.raw_layer, times=args.times, objects=args.objects, path=landing.GOOD
            )
    elif args.staging:
        register_raw(spark, args.raw, args.raw_layer, args.format, args.times, args.objects)
        raw = raw_frames(spark, args.raw_layer)
    else:
        raw = read_all(spark, args.raw, args.format, args.times, args.objects)
    done = refresh(
        spark,
        raw,
        args.as_of,
        layer=args.layer,
        location=args.location,
        keep=args.keep,
        hold=datetime.timedelta(hours=args.hold_hours),
        enforce=not args.warn_only,
        prefix=args.prefix,
        staging=args.staging,
        raw_layer=args.raw_layer,
    )
    print(f"published run {done.run}")
    for row in [*found, *done.checks]:
        print(f"{row.severity} {row.check} {row.relation}.{row.key}: {row.failures}")


if __name__ == "__main__":
    main()
