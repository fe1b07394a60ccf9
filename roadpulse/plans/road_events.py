"""The given ``events`` table seen as road-sensor events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.schema import EVENT_COLUMNS, ROAD_TYPES, ZONES

EVENTS_TABLE = (
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
    "value DOUBLE, props STRING"
)


def _pick(names: list[str], position: Column) -> Column:
    picked = F.when(position == 0, names[0])
    for index, name in enumerate(names[1:-1], start=1):
        picked = picked.when(position == index, name)
    return picked.otherwise(names[-1])


def adapt(events: DataFrame, *keep: str) -> DataFrame:
    """Ten sensors with a fixed road, road type and zone each; readings from the row's values."""
    sensor = F.col("user_id") % 10
    return events.select(
        *keep,
        F.concat(F.lit("S"), F.lpad(sensor.cast("string"), 3, "0")).alias("sensor_id"),
        F.concat(F.lit("R"), F.lpad((sensor * 7 % 20 + 1).cast("string"), 3, "0")).alias(
            "road_id"
        ),
        _pick(list(ROAD_TYPES), sensor % 3).alias("road_type"),
        _pick(ZONES, sensor % 5).alias("zone"),
        (F.floor("value") % 101).alias("vehicle_count"),
        (5 + (F.col("event_id") * 13) % 116).alias("average_speed"),
        F.get_json_object("props", "$.k").cast("double").alias("occupancy_rate"),
        F.col("ts").alias("event_time"),
    )


def road_events(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    table = spark.read.schema(EVENTS_TABLE).parquet(f"{sf_dir}/events.parquet")
    return adapt(table, *keep)


def road_event_stream(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    # As a pattern, the path may be one file as well as a directory of them.
    table = spark.readStream.schema(EVENTS_TABLE).parquet(f"{sf_dir}/events[.]parquet")
    return adapt(table, *keep)


def with_wrong_road(events: DataFrame) -> DataFrame:
    """Some sensors report another road on their errors (needs ``user_id``, ``event_type``)."""
    faulty = (F.col("user_id") < 5) & (F.col("event_type") == "error")
    road = F.when(faulty, "R999").otherwise(F.col("road_id"))
    return events.withColumn("road_id", road).select(*EVENT_COLUMNS)


def _no_object(text: Column) -> Column:
    speed = F.get_json_object(text, "$.average_speed").cast("int") % 4
    return (
        F.when(speed == 0, F.concat(text, F.lit(',"lane":2')))
        .when(speed == 1, F.concat(text, F.lit(',"event":'), text))
        .when(speed == 2, F.concat(text, F.lit(",1]")))
        .otherwise(F.substring(text, F.lit(1), F.length(text) - 1))
    )


def with_defects(messages: DataFrame) -> DataFrame:
    """Messages by ``event_type``: not one whole object, without a zone, or without a valid time; and
    good ones with white space in front and an unknown field, or with a speed written as 45.0.

    Those that are no object are cut off, or go on after it: by a field, by another event, or as
    an array would. Which of these is taken from the speed that the message has.
    """
    text = F.col("value").cast("string")
    kind = F.col("event_type")
    broken = (
        F.when(kind == "error", _no_object(text))
        .when(kind == "signup", F.regexp_replace(text, r'"zone":"[^"]*",', ""))
        .when(kind == "view", F.regexp_replace(text, r'"event_time":"[^"]*"', '"event_time":"?"'))
        .when(kind == "click", F.concat(F.lit("\t\r\n "), F.regexp_replace(text, r"\}$", ',"lane":2}')))
        .when(kind == "purchase", F.regexp_replace(text, r'"average_speed":(\d+)', '"average_speed":$1.0'))
        .otherwise(text)
    )
    return messages.withColumn("value", broken.cast("binary"))
