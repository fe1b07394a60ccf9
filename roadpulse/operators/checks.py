"""Data checks: non-empty gate, plausibility, constancy of sensor attributes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.functions.traffic import implausible, violations


class EmptyTable(RuntimeError):
    """A table that must hold rows holds none."""


def row_count(table: DataFrame, name: str = "rows") -> DataFrame:
    return table.agg(F.count("*").alias(name))


def row_counts(tables: dict[str, DataFrame]) -> dict[str, int]:
    """Rows of several tables, counted in one job; one number per table reaches the driver."""
    counted = [row_count(table).withColumn("name", F.lit(name)) for name, table in tables.items()]
    return {row["name"]: row["rows"] for row in reduce(DataFrame.union, counted).collect()}


def require_rows(rows: DataFrame | int, name: str) -> int:
    """Number of rows of a table, given as such or counted already; raises when there are none."""
    if isinstance(rows, DataFrame):
        rows = row_count(rows).first()["rows"]
    if rows == 0:
        raise EmptyTable(f"no rows in {name}")
    return rows


def implausible_events(events: DataFrame) -> DataFrame:
    """Events outside the physical envelope of their road type, with the violated checks."""
    return events.filter(implausible()).withColumn("violations", violations())


def plausibility_report(events: DataFrame) -> DataFrame:
    """Events and implausible events per road type."""
    return events.groupBy("road_type").agg(
        F.count("*").alias("events"), F.count_if(implausible()).alias("implausible")
    )


def sensor_conflicts(events: DataFrame) -> DataFrame:
    """Sensors seen with more than one road, road type or zone.

    Reduced to distinct combinations before the shuffle, so a sensor that sends a
    third of all events counts no more than any other. Values are counted, never
    collected: a sensor that makes up roads cannot fill a task.
    """
    return conflicts(combinations(events))


ATTRIBUTES = ["road_id", "road_type", "zone"]


def combinations(events: DataFrame) -> DataFrame:
    """What each sensor was seen with; can be put together from any parts of the events."""
    return events.select("sensor_id", *ATTRIBUTES).distinct()


def conflicts(seen: DataFrame) -> DataFrame:
    """``sensor_conflicts`` of what sensors were seen with, each combination once."""
    return (
        seen.groupBy("sensor_id")
        .agg(
            F.count("*").alias("combinations"),
            *[F.count_distinct(name).alias(f"{name}s") for name in ATTRIBUTES],
        )
        .filter(F.col("combinations") > 1)
    )
