"""Job entry point: ``spark-submit lake.py bronze --root hdfs:///lake`` and so on."""

from __future__ import annotations

import argparse

from pavelake.config import WATERMARK, WINDOW, LakeConfig
from pavelake.operators.regression import regressors
from pavelake.plans import announce, catalog, ingest, inspect, publish, refine, score, train
from pavelake.session import build_session
from pavelake.streaming.audit import LateRows

STREAMS = {"bronze": ingest.run, "silver": refine.run, "gold": publish.run, "score": score.run}


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="pavelake")
    parser.add_argument("job", choices=[*STREAMS, "publish", "train", "inspect-silver", "inspect-gold"])
    parser.add_argument("--root", required=True, help="folder of the lake's tables and checkpoints")
    parser.add_argument("--format", default="parquet", help="table format: parquet or delta")
    parser.add_argument("--master")
    parser.add_argument("--source", default="kafka", help="message source: kafka or a file format")
    parser.add_argument("--option", action="append", default=[], metavar="KEY=VALUE", help="message source option")
    parser.add_argument("--hourly-mode", choices=["dates", "complete", "append"], default="dates")
    parser.add_argument("--watermark", default=WATERMARK, help="how late an event may be")
    parser.add_argument("--route-late", action="store_true", help="keep late rows as rejected ones")
    parser.add_argument("--arrival-bounds-clock", action="store_true", help="no event moves the watermark past its arrival")
    parser.add_argument("--window", default=WINDOW, help="length of a window of the hourly metrics")
    parser.add_argument("--copy-slices", type=int, help="slices of stateful dedup; default: as many as shuffle partitions, 0: none")
    parser.add_argument("--max-files-per-trigger", type=int, default=1000, help="files of one micro-batch; 0: no limit")
    parser.add_argument("--keep-versions-seconds", type=int, default=3600, help="how long replaced table versions stay")
    parser.add_argument("--hive", action="store_true", help="with Hive support")
    parser.add_argument("--database", help="name the lake's tables in this database of the catalog")
    parser.add_argument("--table", default="silver", choices=sorted(announce.TABLES), help="table to publish")
    parser.add_argument("--with-nulls", action="store_true", help="publish NULL fields as null")
    parser.add_argument("--rows", type=int, default=100, help="rows that inspection shows of a table")
    parser.add_argument("--trees", type=int, default=200, help="trees of the random forest")
    parser.add_argument("--rounds", type=int, default=200, help="rounds of gradient boosting")
    parser.add_argument("--every", help='micro-batch interval, for example "10 seconds"')
    parser.add_argument("--once", action="store_true", help="work off what is there, then end")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    cfg = LakeConfig(
        args.root,
        table_format=args.format,
        hourly_mode=args.hourly_mode,
        watermark=args.watermark,
        window=args.window,
        copy_slices=args.copy_slices,
        route_late=args.route_late,
        arrival_bounds_clock=args.arrival_bounds_clock,
        max_files_per_trigger=args.max_files_per_trigger or None,
        keep_versions_seconds=args.keep_versions_seconds,
        message_source=args.source,
        message_options=dict(option.split("=", 1) for option in args.option),
    )
    trigger = None
    if args.once:
        trigger = {"availableNow": True}
    elif args.every:
        trigger = {"processingTime": args.every}
    spark = build_session(f"pavelake-{args.job}", args.master, delta=args.format == "delta", hive=args.hive)
    try:
        if args.database:
            catalog.register(spark, cfg, args.database)
            spark.streams.addListener(catalog.Names(spark, cfg, args.database))
        if args.job == "publish":
            announce.run(spark, cfg, trigger, args.table, args.with_nulls)
        elif args.job in STREAMS:
            spark.streams.addListener(LateRows(spark, cfg.table("late_rows"), cfg.table_format))
            STREAMS[args.job](spark, cfg, trigger)
        elif args.job == "train":
            models = regressors(args.trees, args.rounds)
            train.run(spark, cfg, models).leaderboard(spark).show(truncate=False)
        else:
            reader = inspect.inspect_silver if args.job == "inspect-silver" else inspect.inspect_gold
            inspect.show(reader(spark, cfg), args.rows)
        if args.database:
            catalog.register(spark, cfg, args.database)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
