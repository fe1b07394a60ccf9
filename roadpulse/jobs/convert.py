"""Copies the new files of a JSON lake into a Parquet lake."""

from __future__ import annotations

from roadpulse.jobs import arguments
from roadpulse.sources.lake import stream_lake
from roadpulse.streaming.ingest import ONCE, start_conversion


def main(argv: list[str] | None = None) -> None:
    parser = arguments.parser(__doc__)
    parser.add_argument("--source", required=True, help="root of the JSON lake")
    parser.add_argument("--lake", required=True, help="root of the Parquet lake")
    parser.add_argument("--checkpoint", required=True)
    arguments.add_reading(parser)
    options = parser.parse_args(argv)
    spark = arguments.session("road-sensor-convert")
    events = stream_lake(
        spark, options.source, "json", options.read_mode, options.files_per_batch
    )
    start_conversion(events, options.lake, options.checkpoint, trigger=ONCE).awaitTermination()


if __name__ == "__main__":
    main()
