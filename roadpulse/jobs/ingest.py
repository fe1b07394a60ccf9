"""Streams the topic into the lake and sets bad messages aside.

One query, which reads and decodes a message once and commits lake and rejects together, batch by
batch. Counts by date and zone need no second read of the topic: they follow the lake.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from roadpulse.jobs import arguments
from roadpulse.sinks.lake import make_folder
from roadpulse.sources.lake import stream_lake
from roadpulse.streaming.ingest import start_ingest, start_report


def main(argv: list[str] | None = None) -> None:
    parser = arguments.parser(__doc__)
    arguments.add_source(parser)
    arguments.add_lake(parser)
    parser.add_argument("--rejects", required=True, help="directory for rejected messages")
    parser.add_argument("--report", help="directory for events by batch, date and zone")
    options = parser.parse_args(argv)
    spark = arguments.session("road-sensor-ingest")
    trigger = arguments.trigger(options)
    running = [
        start_ingest(
            arguments.messages(spark, options),
            options.lake,
            f"{options.checkpoint}/ingest",
            options.lake_format,
            trigger=trigger,
            rejects=options.rejects,
        )
    ]
    if options.report and not options.once:
        running.append(_report(spark, options, trigger))
    arguments.wait(spark, running, options)
    if options.report and options.once:  # of what the others have just written
        arguments.wait(spark, [_report(spark, options, trigger)], options)


def _report(spark: SparkSession, options: argparse.Namespace, trigger: dict) -> StreamingQuery:
    make_folder(spark, options.lake)
    arrived = stream_lake(spark, options.lake, options.lake_format)
    return start_report(arrived, options.report, f"{options.checkpoint}/report", trigger)


if __name__ == "__main__":
    main()
