"""Computes the indicators from the lake and stores them."""

from __future__ import annotations

from roadpulse.jobs import arguments
from roadpulse.plans.refresh import store_kpis
from roadpulse.sources.lake import read_lake


def main(argv: list[str] | None = None) -> None:
    parser = arguments.parser(__doc__)
    arguments.add_lake(parser)
    arguments.add_store(parser)
    arguments.add_reading(parser, stream=False)
    parser.add_argument("--dates", nargs="+", type=arguments.a_date, help="only these dates")
    options = parser.parse_args(argv)
    spark = arguments.session("road-sensor-process")
    events = read_lake(spark, options.lake, options.lake_format, options.read_mode)
    store_kpis(spark, events, options.store, options.dates)


if __name__ == "__main__":
    main()
