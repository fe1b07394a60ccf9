"""Process, publish and verify the events that are new in the lake."""

from __future__ import annotations

from roadpulse.jobs import arguments
from roadpulse.plans.follow import start_following
from roadpulse.plans.refresh import Refresh, verify
from roadpulse.sources.lake import stream_lake
from roadpulse.streaming.ingest import ONCE


def main(argv: list[str] | None = None) -> None:
    parser = arguments.parser(__doc__)
    arguments.add_lake(parser)
    arguments.add_store(parser)
    arguments.add_reading(parser)
    arguments.add_database(parser, required=False)
    parser.add_argument("--every", help="keep running, with this time between refreshes")
    options = parser.parse_args(argv)
    spark = arguments.session("road-sensor-refresh")
    refresh = Refresh(
        options.lake,
        options.store,
        options.lake_format,
        arguments.database(options),
        tuple(options.tables),
        options.alert_connections,
    )
    trigger = {"processingTime": options.every} if options.every else ONCE
    events = stream_lake(
        spark, options.lake, options.lake_format, options.read_mode, options.files_per_batch
    )
    start_following(spark, refresh, trigger, events=events).awaitTermination()
    # Also when nothing was new: an empty store is an error.
    verify(spark, refresh.store, refresh.database, refresh.published)


if __name__ == "__main__":
    main()
