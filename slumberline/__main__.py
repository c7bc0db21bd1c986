"""Command line: ``python -m slumberline {report,train,publish,score,peek}`` (or through spark-submit)."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from slumberline.functions.clock import UNITS
from slumberline.plans import jobs
from slumberline.rules import PEEK_SIZE, REPLAYED_SENSORS, SPLIT_WEIGHTS, ModelParams, SleepRule
from slumberline.session import build_session, cleared_scratch
from slumberline.sources import topic as topics
from slumberline.sources.events import EventColumns, canonical_events, read_csv_events
from slumberline.sources.schema import EVENT_ID, MESSAGE_FIELDS


def _add_events(parser: argparse.ArgumentParser) -> None:
    names = EventColumns()
    parser.add_argument("--input", required=True, help="event file or folder")
    parser.add_argument("--format", choices=("csv", "parquet"), default="csv")
    parser.add_argument("--time-column", default=names.timestamp)
    parser.add_argument("--sensor-column", default=names.sensor_id)
    parser.add_argument("--value-column", default=names.value)
    parser.add_argument("--id-column", help="column that tells events apart")
    parser.add_argument("--time-unit", choices=UNITS, default=names.unit)


def _add_rule(parser: argparse.ArgumentParser) -> None:
    rule = SleepRule()
    parser.add_argument("--sensor", default=rule.sensor_id)
    parser.add_argument("--threshold", type=float, default=rule.threshold)
    parser.add_argument("--night-start", type=int, default=rule.night_start)
    parser.add_argument("--night-end", type=int, default=rule.night_end)
    parser.add_argument("--zone", default=rule.zone)


def _add_topic(parser: argparse.ArgumentParser) -> None:
    where = parser.add_mutually_exclusive_group(required=True)
    where.add_argument("--files", help="folder of message files")
    where.add_argument("--topic", help="topic of a broker; needs the connector package")
    parser.add_argument("--servers", default=topics.Topic.servers)


def _events(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    columns = EventColumns(
        args.time_column, args.sensor_column, args.value_column, args.id_column, args.time_unit
    )
    if args.format == "csv":
        return read_csv_events(spark, args.input, columns)
    return canonical_events(spark.read.parquet(args.input), columns)


def _rule(args: argparse.Namespace) -> SleepRule:
    return SleepRule(args.sensor, args.threshold, args.night_start, args.night_end, args.zone)


def _topic(args: argparse.Namespace) -> topics.Topic:
    return topics.Topic(args.topic, args.servers)


def report(spark: SparkSession, args: argparse.Namespace) -> None:
    stats, hours = jobs.describe(_events(spark, args), _rule(args))
    jobs.write_tables({path: table for path, table in ((args.stats, stats), (args.hours, hours)) if path})
    stats.show()
    hours.show(24)


def train(spark: SparkSession, args: argparse.Namespace) -> None:
    params = ModelParams(reg_param=args.reg_param, max_iter=args.max_iter, tol=args.tol)
    key = [EVENT_ID] if args.id_column else list(MESSAGE_FIELDS)
    training = jobs.train_and_save(_events(spark, args), _rule(args), args.model, params, key, args.weights)
    for table in (
        training.split_counts(), training.metrics(), training.confusion_matrix(), training.label_distribution()
    ):
        table.show()


def publish(spark: SparkSession, args: argparse.Namespace) -> None:
    records = jobs.replay_records(_events(spark, args), args.sensors)
    if args.count:
        print(f"{records.count()} events to publish")
    if args.files:
        topics.publish_files(records, args.files)
    else:
        topics.publish(records, _topic(args))


def score(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.files:
        records = topics.stream_message_files(spark, args.files, args.max_per_trigger)
    else:
        records = topics.stream_topic(spark, _topic(args), args.starting_offsets, args.max_per_trigger)
    query = jobs.start_scoring(
        spark,
        records,
        _rule(args),
        args.model,
        sink=args.sink,
        checkpoint=args.checkpoint,
        available_now=args.available_now,
        interval=args.interval,
        audit=args.audit,
    )
    query.awaitTermination()


def peek(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.files:
        look = topics.peek_any if args.any_shape else topics.peek
        first = look(topics.read_message_files(spark, args.files), args.n, position=())
    else:
        first = topics.peek_topic(spark, _topic(args), args.n, args.partitions, args.any_shape)
    first.show(args.n, truncate=False)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="slumberline", description=__doc__)
    commands = parser.add_subparsers(required=True)

    def command(run, *parts) -> argparse.ArgumentParser:
        sub = commands.add_parser(run.__name__, formatter_class=argparse.ArgumentDefaultsHelpFormatter)
        sub.set_defaults(run=run)
        for part in parts:
            part(sub)
        return sub

    sub = command(report, _add_events, _add_rule)
    sub.add_argument("--stats", help="folder for the statistics as CSV")
    sub.add_argument("--hours", help="folder for the events per hour as CSV")

    defaults = ModelParams()
    sub = command(train, _add_events, _add_rule)
    sub.add_argument("--model", required=True, help="folder for the fitted model")
    sub.add_argument("--reg-param", type=float, default=defaults.reg_param)
    sub.add_argument("--max-iter", type=int, default=defaults.max_iter)
    sub.add_argument("--tol", type=float, default=defaults.tol)
    sub.add_argument("--weights", type=float, nargs=2, default=list(SPLIT_WEIGHTS), help="train and test share")

    sub = command(publish, _add_events, _add_topic)
    sub.add_argument("--sensors", nargs="+", default=list(REPLAYED_SENSORS))
    sub.add_argument("--count", action="store_true", help="count the events first, in a pass of its own")

    sub = command(score, _add_topic, _add_rule)
    sub.add_argument("--model", required=True, help="folder of a fitted model")
    sub.add_argument("--sink", help="parquet folder; without one, rows go to the console")
    sub.add_argument("--checkpoint", help="folder from which a restart goes on")
    sub.add_argument("--starting-offsets", default="latest")
    sub.add_argument("--max-per-trigger", type=int, help="files or offsets per micro-batch")
    sub.add_argument("--available-now", action="store_true", help="end when the input is used up")
    sub.add_argument("--audit", action="store_true", help="count malformed messages, which takes parsing all of them")
    sub.add_argument("--interval", help='time between micro-batches, e.g. "10 seconds"')

    sub = command(peek, _add_topic)
    sub.add_argument("-n", type=int, default=PEEK_SIZE)
    sub.add_argument("--partitions", type=int, nargs="+", help="partitions of the topic to look into; all unless named")
    sub.add_argument("--any-shape", action="store_true", help="show JSON of any shape, not only the fields of events")
    return parser


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = build_session("slumberline")
    with cleared_scratch(spark):
        args.run(spark, args)


if __name__ == "__main__":
    main()
