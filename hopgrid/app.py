"""Start the matching job, for spark-submit.

    spark-submit hopgrid/app.py --servers host:9092 --driver-topic drivers --passenger-topic passengers \\
        --trips s3a://.../trips --checkpoint s3a://.../checkpoints/trips --map-topic positions

``--replay FOLDER`` reads recorded messages (parquet files of ``value, ts``)
instead of topics, and ``--once`` stops when everything there has been matched.
"""

from __future__ import annotations

import argparse
import dataclasses
import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from hopgrid.config import EXACT, PRICED  # noqa: E402
from hopgrid.operators.records import driver_rows, passenger_rows, republished  # noqa: E402
from hopgrid.session import build_session  # noqa: E402
from hopgrid.sinks.tables import append_stream, send_to_files, send_to_topic  # noqa: E402
from hopgrid.sources.messages import (  # noqa: E402
    accepted, kafka_messages, parse_messages, rejected, replay_messages, split_roles)
from hopgrid.streaming.match import MATCHERS, match_messages, start_match  # noqa: E402

REPEAT_SPAN = "1 hour"


def parse_arguments(arguments: list[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Match drivers and passengers as their messages arrive.")
    parser.add_argument("--servers", help="Kafka bootstrap servers")
    parser.add_argument("--driver-topic")
    parser.add_argument("--passenger-topic")
    parser.add_argument("--replay", help="folder of recorded messages to read instead of topics")
    parser.add_argument("--trips", required=True, help="table folder to append to")
    parser.add_argument("--checkpoint", required=True, help="shared folder for the progress of the queries")
    parser.add_argument("--matcher", choices=sorted(MATCHERS), default="priced")
    parser.add_argument("--window-seconds", type=int)
    parser.add_argument("--bin-size", type=float)
    parser.add_argument("--lateness", help='how late messages may be, such as "30 seconds"')
    parser.add_argument("--stream-parts", type=int, help="blocks per side for crowded bins")
    parser.add_argument("--trip-ids", choices=["random", "stable"])
    parser.add_argument("--map-topic", help="topic that readable messages are passed on to")
    parser.add_argument("--map-folder", help="the same into text files")
    parser.add_argument("--drivers-table", help="folder to append a row per driver to")
    parser.add_argument("--passengers-table", help="folder to append a row per passenger to")
    parser.add_argument("--repeat-span", default=REPEAT_SPAN,
                        help="how long a car or passenger is remembered, so that its repeated messages give one row")
    parser.add_argument("--rejects", help="folder to append unreadable messages to, with the reason")
    parser.add_argument("--once", action="store_true")
    options = parser.parse_args(arguments)
    if not options.replay and not (options.servers and options.driver_topic and options.passenger_topic):
        parser.error("either --replay or --servers, --driver-topic and --passenger-topic")
    return options


def configuration(options: argparse.Namespace):
    base = PRICED if options.matcher in ("priced", "unpriced") else EXACT
    names = ("window_seconds", "bin_size", "lateness", "stream_parts", "trip_ids")
    given = {n: getattr(options, n) for n in names if getattr(options, n) is not None}
    return dataclasses.replace(base, **given)


def source(spark: SparkSession, options: argparse.Namespace) -> DataFrame:
    if options.replay:
        return replay_messages(spark, options.replay, streaming=True)
    return kafka_messages(spark, options.servers, f"{options.driver_topic},{options.passenger_topic}")


def start(spark: SparkSession, options: argparse.Namespace) -> list[StreamingQuery]:
    """One query per sink: trips, and the map if asked for."""
    trigger = {"availableNow": True} if options.once else None
    trips = match_messages(source(spark, options), configuration(options), options.matcher)
    queries = [start_match(trips, options.trips, f"{options.checkpoint}/trips", options.matcher, trigger)]
    values = republished(parse_messages(source(spark, options)))
    if options.map_topic:
        queries.append(send_to_topic(values, options.servers, options.map_topic, f"{options.checkpoint}/map", trigger))
    if options.map_folder:
        queries.append(send_to_files(values, options.map_folder, f"{options.checkpoint}/map-files", trigger))
    drivers, passengers = split_roles(accepted(parse_messages(source(spark, options))))
    tables = ((options.drivers_table, drivers, driver_rows), (options.passengers_table, passengers, passenger_rows))
    for path, messages, rows in tables:
        if path:
            recent = messages.withWatermark("ts", options.repeat_span)
            queries.append(append_stream(rows(recent, dedupe=True), path,
                                         f"{options.checkpoint}/{rows.__name__}", trigger=trigger))
    if options.rejects:
        queries.append(append_stream(rejected(parse_messages(source(spark, options))), options.rejects,
                                     f"{options.checkpoint}/rejects", trigger=trigger))
    return queries


def main(arguments: list[str] | None = None) -> None:
    options = parse_arguments(sys.argv[1:] if arguments is None else arguments)
    spark = build_session("hopgrid-match")
    queries = start(spark, options)
    if options.once:
        for query in queries:
            query.awaitTermination()
    else:
        spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()
