"""Expressions over one sensor event."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadpulse.schema import (
    DAY_HOURS,
    MIN_SPEED,
    OCCUPANCY_LIMIT,
    OCCUPANCY_RANGE,
    ROAD_TYPES,
    RUSH_HOURS,
    SPEED_LIMIT,
    SPEED_TOLERANCE,
    RoadType,
)


def congested(speed_limit: int = SPEED_LIMIT, occupancy_limit: float = OCCUPANCY_LIMIT) -> Column:
    """Slow or full. Left bare so that a filter on it reaches the Parquet scan."""
    return (F.col("average_speed") < speed_limit) | (F.col("occupancy_rate") > occupancy_limit)


def congestion_flag(
    speed_limit: int = SPEED_LIMIT, occupancy_limit: float = OCCUPANCY_LIMIT
) -> Column:
    """The same as a boolean that is never NULL: unknown counts as not congested."""
    return F.coalesce(congested(speed_limit, occupancy_limit), F.lit(False))


def wall_time(column: str = "event_time") -> Column:
    """Wall-clock time of text or typed input; NULL where the text is no time.

    An offset in the text is ignored, so an event keeps the hour and the date its
    sensor wrote. On a typed column the cast disappears from the plan.
    """
    return F.col(column).try_cast("timestamp_ntz")


def event_hour(column: str = "event_time") -> Column:
    return F.hour(wall_time(column))


def event_date(column: str = "event_time") -> Column:
    return F.to_date(wall_time(column))


def day_period(column: str = "event_time") -> Column:
    """``rush``, ``day`` or ``night`` by hour of day; NULL without a time."""
    hour = event_hour(column)
    return (
        F.when(_any(hour.between(first, last) for first, last in RUSH_HOURS), "rush")
        .when(hour.between(*DAY_HOURS), "day")
        .when(hour.isNotNull(), "night")
    )


def _outside(column: str, low: float, high: float) -> Column:
    return (F.col(column) < low) | (F.col(column) > high)


def _any(checks) -> Column:
    return reduce(or_, checks)


def _road_checks(road: RoadType) -> dict[str, Column]:
    """Checks against the envelope of one road type."""
    # Speeds are whole km/h, so the ceiling is the largest whole speed allowed.
    ceiling = int(round(road.max_speed * SPEED_TOLERANCE, 6))
    return {
        "vehicle_count": _outside("vehicle_count", 0, road.capacity),
        "average_speed": _outside("average_speed", MIN_SPEED, ceiling),
    }


def _common_checks() -> dict[str, Column]:
    return {
        "occupancy_rate": _outside("occupancy_rate", *OCCUPANCY_RANGE),
        "road_type": F.col("road_type").isNull() | ~F.col("road_type").isin(*ROAD_TYPES),
    }


def _of(name: str) -> Column:
    return F.col("road_type") == name


def implausible() -> Column:
    """True where an event lies outside the physical envelope of its road type.

    The three-row envelope is folded into the predicate as literals: no join is
    planned, and the comparisons can be pushed to the scan.
    """
    by_road = [_of(name) & _any(_road_checks(road).values()) for name, road in ROAD_TYPES.items()]
    return _any([*by_road, *_common_checks().values()])


def envelope_checks() -> dict[str, Column]:
    """The single checks behind ``implausible`` by name."""
    roads = {name: _road_checks(road) for name, road in ROAD_TYPES.items()}
    return {
        **{
            check: _any(_of(name) & checks[check] for name, checks in roads.items())
            for check in ("vehicle_count", "average_speed")
        },
        **_common_checks(),
    }


def violations() -> Column:
    """Names of the violated checks, comma-separated, in a fixed order."""
    return F.concat_ws(",", *[F.when(check, name) for name, check in envelope_checks().items()])
