"""Jobs for spark-submit.

    spark-submit wavelode/cli.py publish --csv tracks.csv --messages s3a://x/messages
    spark-submit wavelode/cli.py bronze --messages s3a://x/messages --root s3a://x/lake
    spark-submit wavelode/cli.py silver --root s3a://x/lake --seconds 180
    spark-submit wavelode/cli.py gold --root s3a://x/lake --keep 3
    spark-submit wavelode/cli.py gold --root s3a://x/lake --parts 256
    spark-submit wavelode/cli.py windows --root s3a://x/lake --width "1 day" --delay "1 day"
    spark-submit wavelode/cli.py latest --root s3a://x/lake
    spark-submit wavelode/cli.py report --root s3a://x/lake --out s3a://x/report
    spark-submit wavelode/cli.py features --root s3a://x/lake
    spark-submit wavelode/cli.py train --root s3a://x/lake --out s3a://x/training

With ``--servers`` and ``--topic`` the messages come from and go to a broker. ``silver
--outcomes`` also writes rejected and late rows and their counts; ``gold --parts`` keeps
one table of which a trigger rewrites the parts that changed.
"""

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wavelode.operators.features import feature_table, track_features  # noqa: E402
from wavelode.operators.models import hash_split  # noqa: E402
from wavelode.operators.quality import latest_per_key  # noqa: E402
from wavelode.operators.sinks import overwrite, publish  # noqa: E402
from wavelode.plans.report import report  # noqa: E402
from wavelode.plans.training import save_training, train_models  # noqa: E402
from wavelode.session import build_session  # noqa: E402
from wavelode.sources.events import event_stream, to_events  # noqa: E402
from wavelode.sources.files import read_tracks_csv, table  # noqa: E402
from wavelode.streaming.jobs import (  # noqa: E402
    KEEP, Layout, run_layers, start_bronze, start_gold, start_gold_updates, start_latest,
    start_silver, start_silver_outcomes, start_windows,
)
from wavelode.streaming.keyed import PARTS  # noqa: E402
from wavelode.streaming.sinks import DEFAULT_TRIGGER, run_stream  # noqa: E402


def _rate(args, kafka=False):
    """How much of a backlog a trigger takes."""
    if kafka:
        return {"maxOffsetsPerTrigger": args.max_offsets} if args.max_offsets else {}
    return {"maxFilesPerTrigger": args.max_files} if args.max_files else {}


def _messages(spark, args):
    if args.topic:
        return event_stream(
            spark, "kafka", servers=args.servers, topic=args.topic, **_rate(args, kafka=True))
    return event_stream(spark, "parquet", args.messages, **_rate(args))


def run_publish(spark, args):
    events = to_events(read_tracks_csv(spark, args.csv, args.multi_line))
    if args.topic:
        publish(events, "kafka", servers=args.servers, topic=args.topic)
    else:
        publish(events, "parquet", args.messages)


def run_bronze(spark, args):
    run_stream(start_bronze(_messages(spark, args), args.layout, args.trigger), args.seconds)


def _watermark(args):
    return ("event_timestamp", args.watermark) if args.watermark else None


def run_silver(spark, args):
    start = start_silver_outcomes if args.outcomes else start_silver
    query = start(
        spark, args.layout, args.trigger, watermark=_watermark(args),
        state_partitions=args.state_partitions, **_rate(args),
    )
    run_stream(query, args.seconds)


def run_gold(spark, args):
    options = dict(state_partitions=args.state_partitions, keep=args.keep, **_rate(args))
    if args.parts:
        query = start_gold_updates(
            spark, args.layout, args.trigger, parts=args.parts, **options)
    else:
        query = start_gold(spark, args.layout, args.trigger, **options)
    run_stream(query, args.seconds)


def run_windows(spark, args):
    name = args.table or f"windows_{args.width.replace(' ', '_')}"
    query = start_windows(
        spark, args.layout, name, args.width, args.delay, args.trigger,
        state_partitions=args.state_partitions, **_rate(args),
    )
    run_stream(query, args.seconds)


def run_latest(spark, args):
    query = start_latest(
        spark, args.layout, args.trigger, state_partitions=args.state_partitions,
        parts=args.parts or PARTS, keep=args.keep, **_rate(args),
    )
    run_stream(query, args.seconds)


def run_all_layers(spark, args):
    run_layers(
        spark, _messages(spark, args), args.layout, watermark=_watermark(args),
        state_partitions=args.state_partitions, keep=args.keep, **_rate(args),
    )


def _silver(spark, args):
    rows = table(spark, args.layout.path("silver"), args.format)
    if args.latest:
        return latest_per_key(rows, ["track_id"], ["event_timestamp"])
    return rows


def run_report(spark, args):
    for name, rows in report(_silver(spark, args)).items():
        overwrite(rows, f"{args.out}/{name}", args.format)


def run_features(spark, args):
    overwrite(
        feature_table(_silver(spark, args)), args.layout.path("features"), args.format
    )


def run_train(spark, args):
    train, test = hash_split(track_features(_silver(spark, args)), "track_id")
    trained = train_models(train, test, trees=args.trees, rounds=args.rounds)
    best = save_training(
        spark, trained, args.out, args.experiment, args.layout.path("silver"),
        keys=["track_id", "event_time"],
    )
    trained.comparison().show(truncate=False)
    print("best model:", best)


JOBS = {
    "publish": run_publish, "bronze": run_bronze, "silver": run_silver,
    "gold": run_gold, "windows": run_windows, "latest": run_latest,
    "layers": run_all_layers, "report": run_report,
    "features": run_features, "train": run_train,
}


def parse(argv):
    parser = argparse.ArgumentParser()
    parser.add_argument("job", choices=JOBS)
    parser.add_argument("--root", default="lake", help="folder of the layer tables")
    parser.add_argument("--format", default="parquet", choices=["parquet", "delta"])
    parser.add_argument("--csv", help="track file to publish")
    parser.add_argument("--multi-line", action="store_true")
    parser.add_argument("--messages", help="folder of message files")
    parser.add_argument("--servers", help="broker addresses")
    parser.add_argument("--topic")
    parser.add_argument("--trigger", default=DEFAULT_TRIGGER)
    parser.add_argument("--seconds", type=int, default=0, help="0 runs until stopped")
    parser.add_argument("--watermark", help="how late copies may come, e.g. '1 day'")
    parser.add_argument(
        "--outcomes", action="store_true", help="also write rejected and late rows")
    parser.add_argument("--keep", type=int, default=KEEP, help="older Gold tables that stay")
    parser.add_argument("--parts", type=int, help="parts of a table that is kept up to date")
    parser.add_argument("--width", default="1 day", help="of a window of event time")
    parser.add_argument("--delay", default="1 day", help="how late rows of a window may come")
    parser.add_argument("--table", help="name of the table of windows")
    parser.add_argument("--state-partitions", type=int)
    parser.add_argument("--max-files", type=int, help="files of a backlog in one trigger")
    parser.add_argument("--max-offsets", type=int, help="messages of a backlog in one trigger")
    parser.add_argument(
        "--latest", action="store_true", help="use only the newest event of each track"
    )
    parser.add_argument("--out", default="out")
    parser.add_argument("--experiment", default="tracks")
    parser.add_argument("--trees", type=int, default=100)
    parser.add_argument("--rounds", type=int, default=100)
    args = parser.parse_args(argv)
    args.layout = Layout(args.root, args.format)
    return args


def main(argv=None, spark=None):
    args = parse(argv)
    session = spark or build_session(f"tracks {args.job}", table_format=args.format)
    try:
        JOBS[args.job](session, args)
    finally:
        if spark is None:
            session.stop()


if __name__ == "__main__":
    main()
