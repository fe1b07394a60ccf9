"""The dashboard queries over the stored indicator tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.schema import LATEST_ALERTS, PREVIEW_ROWS, TOP_ZONES


def _falling(column: str):
    return F.col(column).desc_nulls_last()


def _rising(column: str):
    return F.col(column).asc_nulls_last()


def traffic_by_hour(hourly_stats: DataFrame) -> DataFrame:
    return (
        hourly_stats.groupBy("hour")
        .agg(F.avg("avg_vehicles").alias("avg_vehicles"))
        .orderBy(_rising("hour"))
    )


def speed_by_road(table: DataFrame) -> DataFrame:
    return table.select("road_type", "avg_speed").orderBy(
        _falling("avg_speed"), _rising("road_type")
    )


def traffic_by_zone(table: DataFrame) -> DataFrame:
    return table.select("zone", "avg_vehicles").orderBy(_falling("avg_vehicles"), _rising("zone"))


def critical_zones(table: DataFrame, k: int = TOP_ZONES) -> DataFrame:
    return (
        table.select("zone", "congestion_count")
        .orderBy(_falling("congestion_count"), _rising("zone"))
        .limit(k)
    )


def latest_alerts(
    table: DataFrame, k: int = LATEST_ALERTS, since: DataFrame | None = None
) -> DataFrame:
    """The ``k`` newest alerts: a top-k per task and one merge, no global sort.

    ``since`` (see ``summary.newest_alert_dates``) narrows the read of an alert
    table partitioned by date to the dates that can hold the answer.
    """
    if since is not None:
        # A subquery of one row: it prunes partitions when the query runs.
        start = since.select("since").scalar()
        table = table.filter(start.isNull() | (F.col("date") >= start))
    return (
        table.select("zone", "road_type", "average_speed", "event_time")
        .orderBy(
            _falling("event_time"),
            _rising("zone"),
            _rising("road_type"),
            _rising("average_speed"),
        )
        .limit(k)
    )


def preview(table: DataFrame, rows: int = PREVIEW_ROWS) -> DataFrame:
    """The first rows of a table, for a look at it."""
    return table.limit(rows)
