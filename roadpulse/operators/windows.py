"""Traffic of the last hour, and hour by hour on a stream."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.functions.traffic import event_date, event_hour, wall_time

UTC_NAMES = ("UTC", "Etc/UTC", "GMT", "Z")


def _literal(moment: datetime) -> Column:
    if moment.tzinfo is not None:
        raise ValueError("event times carry no offset: give a naive wall-clock time")
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def between(events: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Events in ``[start, end)``; on the lake only the dates touched are read."""
    if "date" in events.columns:
        last = end - timedelta(microseconds=1)
        events = events.filter(F.col("date").between(F.lit(start.date()), F.lit(last.date())))
    return events.filter((wall_time() >= _literal(start)) & (wall_time() < _literal(end)))


def last_hour(events: DataFrame, as_of: datetime) -> DataFrame:
    """Events of the hour that ends at ``as_of``, which is not included."""
    return between(events, as_of - timedelta(hours=1), as_of)


def hour_start() -> Column:
    """The full hour of an event, as wall-clock time in any session; NULL without a time."""
    return event_date().cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), event_hour())


def hourly_sums(events: DataFrame) -> DataFrame:
    """Traffic by zone and full hour as sums, which can be added up (see ``added_hours``).

    Events without a time form the NULL hour.
    """
    return events.groupBy(hour_start().alias("window_start"), "zone").agg(
        F.sum("vehicle_count").alias("vehicles"),
        F.count("vehicle_count").alias("counted"),
        F.count("*").alias("events"),
    )


def merged_hours(sums: DataFrame) -> DataFrame:
    """Any number of ``hourly_sums`` as one."""
    measures = [F.sum(x).alias(x) for x in ("vehicles", "counted", "events")]
    return sums.groupBy("window_start", "zone").agg(*measures)


def added_hours(sums: DataFrame) -> DataFrame:
    """Hourly traffic by zone from any number of ``hourly_sums``."""
    added = sums.groupBy("window_start", "zone").agg(
        F.try_divide(F.sum("vehicles"), F.sum("counted")).alias("avg_vehicles"),
        F.sum("events").alias("events"),
    )
    end = F.col("window_start") + F.make_dt_interval(F.lit(0), F.lit(1))
    return added.select("window_start", end.alias("window_end"), "zone", "avg_vehicles", "events")


def hourly_by_zone(
    events: DataFrame, delay: str | None = "10 minutes", length: str = "1 hour"
) -> DataFrame:
    """Tumbling windows per zone, for streams.

    ``delay`` is how long a window waits for late events before its state is
    dropped and, in append mode, its row is sent. Without it every window is kept.
    Watermarks need TIMESTAMP, so the stream must run in a UTC session, where the
    wall-clock times pass through unchanged (see ``streaming.session``).
    """
    zone = events.sparkSession.conf.get("spark.sql.session.timeZone")
    if zone not in UTC_NAMES:
        raise ValueError(f"windows would be cut in {zone}: use a UTC session")
    timed = events.withColumn("event_time", wall_time().cast("timestamp"))
    if delay is not None:
        timed = timed.withWatermark("event_time", delay)
    return (
        timed.groupBy(F.window("event_time", length).alias("window"), "zone")
        .agg(F.avg("vehicle_count").alias("avg_vehicles"), F.count("*").alias("events"))
        .select(
            F.col("window.start").cast("timestamp_ntz").alias("window_start"),
            F.col("window.end").cast("timestamp_ntz").alias("window_end"),
            "zone",
            "avg_vehicles",
            "events",
        )
    )
