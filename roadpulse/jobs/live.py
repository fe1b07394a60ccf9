"""Streams congestion alerts, and hourly traffic by zone, straight from the topic."""

from __future__ import annotations

from roadpulse.jobs import arguments
from roadpulse.operators.ingest import accepted, decode
from roadpulse.streaming.live import start_live


def main(argv: list[str] | None = None) -> None:
    parser = arguments.parser(__doc__)
    arguments.add_source(parser)
    parser.add_argument("--alerts", required=True, help="directory for the alerts")
    parser.add_argument("--hours", required=True, help="directory for the hourly sums")
    options = parser.parse_args(argv)
    spark = arguments.session("road-sensor-live")
    events = accepted(decode(arguments.messages(spark, options)))
    running = start_live(
        events, options.alerts, options.hours, options.checkpoint, arguments.trigger(options)
    )
    arguments.wait(spark, [running], options)


if __name__ == "__main__":
    main()
