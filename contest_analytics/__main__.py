"""Command line: ``python -m contest_analytics {reports,outcome,duration,layout,update} FOLDER OUTPUT``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from contest_analytics.plans import analytics, models, updates
from contest_analytics.sources import bucketed
from contest_analytics.sources.layouts import load_match_files


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="contest_analytics")
    parser.add_argument("task", choices=["reports", "outcome", "duration", "layout", "update"])
    parser.add_argument("folder", help="folder with the match CSV files, or a layout of them")
    parser.add_argument("output", help="folder for the results; any URI Spark can write")
    parser.add_argument("--compact", action="store_true", help="smaller feature set and lighter trees")
    parser.add_argument("--overwrite", action="store_true")
    parser.add_argument("--matched-only", action="store_true", help="reports: leave out draft rows without a match")
    parser.add_argument("--known-periods", action="store_true", help="reports: leave out rows without a period")
    parser.add_argument("--known-durations", action="store_true", help="reports: leave out matches of unknown length")
    parser.add_argument("--min-count", type=int, default=50, help="reports: least games of a phase win rate")
    parser.add_argument("--buckets", type=int, help="layout: number of buckets")
    parser.add_argument("--state", help="update: folder of what is kept between runs")
    parser.add_argument("--part", help="update: name of the matches in this folder")
    args = parser.parse_args(argv)
    if args.task == "update" and not (args.state and args.part):
        parser.error("update needs --state and --part")
    mode = "overwrite" if args.overwrite else "errorifexists"
    spark = SparkSession.builder.appName("contest_analytics").getOrCreate()
    if args.task == "layout":
        bucketed.write_layout(load_match_files(spark, args.folder), args.output, args.buckets)
        counts = {}
    elif args.task == "update":
        counts = updates.run(spark, args.folder, args.state, args.part, args.output)
    elif args.task == "reports":
        counts = analytics.run(
            spark,
            args.folder,
            args.output,
            mode=mode,
            min_count=args.min_count,
            how="inner" if args.matched_only else "left",
            drop_null_period=args.known_periods,
            null_bucket="drop" if args.known_durations else None,
        )
    else:
        counts = models.run(spark, args.folder, args.output, args.task, args.compact, mode)
    for name, n_records in counts.items():
        print(f"{name}: {n_records:,} records")


if __name__ == "__main__":
    main()
