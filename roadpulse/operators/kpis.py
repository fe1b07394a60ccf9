"""The five indicators, computed straight from events.

Each is a hash aggregate with map-side combine over a handful of groups, so what
is shuffled does not grow with the input. Results carry no order: order belongs
to the dashboard queries, a stored table does not keep it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.functions.traffic import congested, congestion_flag, day_period, event_hour
from roadpulse.functions.traffic import wall_time
from roadpulse.schema import ALERT_COLUMNS, OCCUPANCY_LIMIT, SPEED_LIMIT


def traffic_by_zone(events: DataFrame) -> DataFrame:
    return events.groupBy("zone").agg(
        F.avg("vehicle_count").alias("avg_vehicles"), F.count("*").alias("event_count")
    )


def speed_by_road(events: DataFrame) -> DataFrame:
    return events.groupBy("road_type").agg(F.avg("average_speed").alias("avg_speed"))


def flag_congestion(
    events: DataFrame, speed_limit: int = SPEED_LIMIT, occupancy_limit: float = OCCUPANCY_LIMIT
) -> DataFrame:
    return events.withColumn("is_congested", congestion_flag(speed_limit, occupancy_limit))


def congestion_alerts(
    events: DataFrame, speed_limit: int = SPEED_LIMIT, occupancy_limit: float = OCCUPANCY_LIMIT
) -> DataFrame:
    """The congested events. Stateless, so it is also the live alert stream."""
    return (
        events.filter(congested(speed_limit, occupancy_limit))
        .withColumn("event_time", wall_time())
        .select(*ALERT_COLUMNS)
    )


def hourly_stats(events: DataFrame) -> DataFrame:
    """Profile by hour of day, pooled over all days; events without a time form the NULL hour."""
    return events.groupBy(event_hour().alias("hour")).agg(
        F.avg("vehicle_count").alias("avg_vehicles"),
        F.avg("average_speed").alias("avg_speed"),
    )


def critical_zones(
    events: DataFrame, speed_limit: int = SPEED_LIMIT, occupancy_limit: float = OCCUPANCY_LIMIT
) -> DataFrame:
    """Congested events per zone; zones without any are kept with 0."""
    return events.groupBy("zone").agg(
        F.count_if(congested(speed_limit, occupancy_limit)).alias("congestion_count")
    )


def day_period_stats(events: DataFrame) -> DataFrame:
    return events.groupBy(day_period().alias("day_period")).agg(
        F.avg("vehicle_count").alias("avg_vehicles"), F.count("*").alias("event_count")
    )
