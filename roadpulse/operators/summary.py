"""One mergeable summary of the events, from which every aggregate indicator follows.

At lake scale the reads dominate. Four indicators computed apart read the events
four times; the summary reads them once and shrinks each task's share to a few
hundred rows before the shuffle. It holds sums and counts by date, so a refresh
replaces the dates that changed and never reads the others again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.functions.traffic import congested, event_date, event_hour
from roadpulse.schema import OCCUPANCY_LIMIT, SPEED_LIMIT, SUMMARY

GROUPS = ["date", "hour", "zone", "road_type"]


def summarize(
    events: DataFrame, speed_limit: int = SPEED_LIMIT, occupancy_limit: float = OCCUPANCY_LIMIT
) -> DataFrame:
    """Sums and counts per ``(date, hour, zone, road_type)``.

    Sums are doubles as in ``avg``: whole numbers up to 2^53 stay exact, and an
    absurd reading cannot overflow the job.
    """
    date = F.col("date") if "date" in events.columns else event_date().alias("date")
    return events.groupBy(date, event_hour().alias("hour"), "zone", "road_type").agg(
        F.sum(F.col("vehicle_count").cast("double")).alias("vehicle_sum"),
        F.count("vehicle_count").alias("vehicle_readings"),
        F.sum(F.col("average_speed").cast("double")).alias("speed_sum"),
        F.count("average_speed").alias("speed_readings"),
        F.count("*").alias("events"),
        F.count_if(congested(speed_limit, occupancy_limit)).alias("congested"),
    )


def merge(summaries: DataFrame) -> DataFrame:
    """Rows of several summaries put together: one row per group again."""
    measures = [f.name for f in SUMMARY if f.name not in GROUPS]
    return summaries.groupBy(*GROUPS).agg(*[F.sum(name).alias(name) for name in measures])


def _mean(total: str, readings: str) -> Column:
    return F.try_divide(F.sum(total), F.sum(readings))


def traffic_by_zone(summary: DataFrame) -> DataFrame:
    return summary.groupBy("zone").agg(
        _mean("vehicle_sum", "vehicle_readings").alias("avg_vehicles"),
        F.sum("events").alias("event_count"),
    )


def speed_by_road(summary: DataFrame) -> DataFrame:
    return summary.groupBy("road_type").agg(
        _mean("speed_sum", "speed_readings").alias("avg_speed")
    )


def hourly_stats(summary: DataFrame) -> DataFrame:
    return summary.groupBy("hour").agg(
        _mean("vehicle_sum", "vehicle_readings").alias("avg_vehicles"),
        _mean("speed_sum", "speed_readings").alias("avg_speed"),
    )


def critical_zones(summary: DataFrame) -> DataFrame:
    return summary.groupBy("zone").agg(F.sum("congested").alias("congestion_count"))


def indicators(summary: DataFrame) -> dict[str, DataFrame]:
    """The four aggregate indicators by table name."""
    return {
        "traffic_by_zone": traffic_by_zone(summary),
        "speed_by_road": speed_by_road(summary),
        "hourly_stats": hourly_stats(summary),
        "critical_zones": critical_zones(summary),
    }


def newest_alert_dates(summary: DataFrame, alerts: int) -> DataFrame:
    """One row ``since``: from this date on there are at least ``alerts`` alerts.

    Lets the latest-alerts query open a few date partitions instead of the whole
    table. NULL when there are fewer alerts than asked for.
    """
    by_date = summary.groupBy("date").agg(F.sum("congested").alias("congested"))
    newest = by_date.filter("congested > 0 AND date IS NOT NULL")
    # At most `alerts` dates are needed, as each of these has an alert.
    head = newest.orderBy(F.col("date").desc()).limit(alerts)
    running = head.select(
        "date",
        F.expr(
            "sum(congested) OVER (ORDER BY date DESC "
            "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
        ).alias("so_far"),
    )
    return running.filter(F.col("so_far") >= alerts).agg(F.max("date").alias("since"))
