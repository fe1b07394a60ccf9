"""Schemas and fixed values shared by every stage."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Raw zone: what a sensor sends, one JSON object per event. The time stays text
# there, because writing a typed timestamp as JSON cuts it to milliseconds.
RAW_EVENT = T.StructType(
    [
        T.StructField("sensor_id", T.StringType()),
        T.StructField("road_id", T.StringType()),
        T.StructField("road_type", T.StringType()),
        T.StructField("zone", T.StringType()),
        T.StructField("vehicle_count", T.LongType()),
        T.StructField("average_speed", T.LongType()),
        T.StructField("occupancy_rate", T.DoubleType()),
        T.StructField("event_time", T.StringType()),
    ]
)
EVENT_COLUMNS = RAW_EVENT.fieldNames()

# Readings as JSON may write them: 45, 45.0 or 45.5. They become whole numbers when read.
WHOLE = ["vehicle_count", "average_speed"]
WIRE_EVENT = T.StructType(
    [T.StructField(f.name, T.DoubleType() if f.name in WHOLE else f.dataType) for f in RAW_EVENT]
)
# Raw zone, in front of the partition columns: the whole message, where the event does not hold all of it.
EXTRA = "message"

# Typed view: sensors report wall-clock time without an offset, which is exactly
# TIMESTAMP_NTZ. Hours and dates then do not depend on the session time zone.
EVENT = T.StructType(
    [
        T.StructField(f.name, T.TimestampNTZType() if f.name == "event_time" else f.dataType)
        for f in RAW_EVENT
    ]
)

LAKE_PARTITIONS = T.StructType(
    [T.StructField("date", T.DateType()), T.StructField("zone", T.StringType())]
)

ALERT_COLUMNS = ["zone", "road_type", "average_speed", "occupancy_rate", "event_time"]

KPI_SCHEMAS = {
    "traffic_by_zone": T.StructType(
        [
            T.StructField("zone", T.StringType()),
            T.StructField("avg_vehicles", T.DoubleType()),
            T.StructField("event_count", T.LongType()),
        ]
    ),
    "speed_by_road": T.StructType(
        [
            T.StructField("road_type", T.StringType()),
            T.StructField("avg_speed", T.DoubleType()),
        ]
    ),
    "congestion_alerts": T.StructType([EVENT[name] for name in ALERT_COLUMNS]),
    "hourly_stats": T.StructType(
        [
            T.StructField("hour", T.IntegerType()),
            T.StructField("avg_vehicles", T.DoubleType()),
            T.StructField("avg_speed", T.DoubleType()),
        ]
    ),
    "critical_zones": T.StructType(
        [
            T.StructField("zone", T.StringType()),
            T.StructField("congestion_count", T.LongType()),
        ]
    ),
}
KPI_NAMES = list(KPI_SCHEMAS)

# Sums and counts that the four aggregate indicators are made of.
SUMMARY = T.StructType(
    [
        T.StructField("hour", T.IntegerType()),
        T.StructField("zone", T.StringType()),
        T.StructField("road_type", T.StringType()),
        T.StructField("vehicle_sum", T.DoubleType()),
        T.StructField("vehicle_readings", T.LongType()),
        T.StructField("speed_sum", T.DoubleType()),
        T.StructField("speed_readings", T.LongType()),
        T.StructField("events", T.LongType()),
        T.StructField("congested", T.LongType()),
        T.StructField("date", T.DateType()),
    ]
)


@dataclass(frozen=True)
class RoadType:
    capacity: int
    max_speed: int


# ---- fixed values -----------------------------------------------------------
# Congestion: slower than this (km/h), or fuller than this (percent); both strict.
SPEED_LIMIT = 40
OCCUPANCY_LIMIT = 70

# Rush hours and daytime hours, both ends included.
RUSH_HOURS = ((7, 9), (17, 19))
DAY_HOURS = (6, 22)

# Physical envelope of each road type; speeds may exceed the maximum by a tenth.
ZONES = ["Downtown", "Industrial", "Residential-North", "Residential-South", "Suburbs"]
ROAD_TYPES = {
    "Highway": RoadType(capacity=100, max_speed=120),
    "Avenue": RoadType(capacity=50, max_speed=60),
    "Street": RoadType(capacity=20, max_speed=50),
}
MIN_SPEED = 5
SPEED_TOLERANCE = 1.1
OCCUPANCY_RANGE = (0, 100)

TOPIC = "traffic-events"
CONSUMER_GROUP = "hdfs-ingest-group"
PREVIEW_ROWS = 20
TOP_ZONES = 5
LATEST_ALERTS = 10
# -----------------------------------------------------------------------------
