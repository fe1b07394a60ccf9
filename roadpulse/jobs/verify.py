"""Fails unless the stored tables, and those of the database if named, hold their rows."""

from __future__ import annotations

from roadpulse.jobs import arguments
from roadpulse.plans.refresh import verify


def main(argv: list[str] | None = None) -> dict[str, int]:
    parser = arguments.parser(__doc__)
    arguments.add_store(parser)
    arguments.add_database(parser, required=False)
    options = parser.parse_args(argv)
    spark = arguments.session("road-sensor-verify")
    counts = verify(spark, options.store, arguments.database(options), options.tables)
    for name, rows in counts.items():
        print(f"{name}: {rows} rows")
    return counts


if __name__ == "__main__":
    main()
