"""Loads the stored tables into the serving database."""

from __future__ import annotations

from roadpulse.jobs import arguments
from roadpulse.plans.refresh import publish


def main(argv: list[str] | None = None) -> None:
    parser = arguments.parser(__doc__)
    arguments.add_store(parser)
    arguments.add_database(parser, required=True)
    options = parser.parse_args(argv)
    spark = arguments.session("road-sensor-publish")
    publish(
        spark,
        options.store,
        arguments.database(options),
        options.tables,
        options.alert_connections,
    )


if __name__ == "__main__":
    main()
