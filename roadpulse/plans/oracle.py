"""The registered queries as SQL for DuckDB, over the whole ``events`` table."""

from __future__ import annotations

_V = """
SELECT 'S' || lpad(CAST(user_id % 10 AS VARCHAR), 3, '0') AS sensor_id,
       'R' || lpad(CAST((user_id % 10) * 7 % 20 + 1 AS VARCHAR), 3, '0') AS road_id,
       CASE (user_id % 10) % 3 WHEN 0 THEN 'Highway' WHEN 1 THEN 'Avenue'
            ELSE 'Street' END AS road_type,
       CASE (user_id % 10) % 5 WHEN 0 THEN 'Downtown' WHEN 1 THEN 'Industrial'
            WHEN 2 THEN 'Residential-North' WHEN 3 THEN 'Residential-South'
            ELSE 'Suburbs' END AS zone,
       CAST(floor(value) AS BIGINT) % 101 AS vehicle_count,
       5 + (event_id * 13) % 116 AS average_speed,
       CAST(json_extract_string(props, '$.k') AS DOUBLE) AS occupancy_rate,
       ts AS event_time,
       event_id, user_id, event_type
FROM events
"""

_CONGESTED = "average_speed < 40 OR occupancy_rate > 70"

_TRAFFIC_BY_ZONE = (
    "SELECT zone, avg(vehicle_count) AS avg_vehicles, count(*) AS event_count FROM v GROUP BY zone"
)
_SPEED_BY_ROAD = "SELECT road_type, avg(average_speed) AS avg_speed FROM v GROUP BY road_type"
_ALERTS = f"""
SELECT zone, road_type, average_speed, occupancy_rate, event_time FROM v WHERE {_CONGESTED}
"""
_HOURLY_STATS = """
SELECT CAST(hour(event_time) AS INT) AS hour, avg(vehicle_count) AS avg_vehicles,
       avg(average_speed) AS avg_speed
FROM v GROUP BY hour(event_time)
"""
_CRITICAL_ZONES = f"""
SELECT zone, count(CASE WHEN {_CONGESTED} THEN 1 END) AS congestion_count FROM v GROUP BY zone
"""
_TRAFFIC_BY_HOUR = f"""
SELECT hour, avg(avg_vehicles) AS avg_vehicles FROM ({_HOURLY_STATS}) t GROUP BY hour
ORDER BY hour
"""
_LATEST_ALERTS = f"""
SELECT zone, road_type, average_speed, event_time FROM v WHERE {_CONGESTED}
ORDER BY event_time DESC, zone, road_type, average_speed LIMIT 10
"""
_SUMMARY = f"""
SELECT CAST(event_time AS DATE) AS date, CAST(hour(event_time) AS INT) AS hour, zone, road_type,
       CAST(sum(vehicle_count) AS DOUBLE) AS vehicle_sum,
       count(vehicle_count) AS vehicle_readings,
       CAST(sum(average_speed) AS DOUBLE) AS speed_sum,
       count(average_speed) AS speed_readings,
       count(*) AS events,
       count(CASE WHEN {_CONGESTED} THEN 1 END) AS congested
FROM v GROUP BY ALL
"""
_PARTITION_COUNTS = """
SELECT CAST(event_time AS DATE) AS date, zone, count(*) AS events
FROM v GROUP BY CAST(event_time AS DATE), zone
"""
_LAKE = """
SELECT sensor_id, road_id, road_type, zone, vehicle_count, average_speed, occupancy_rate,
       event_time, CAST(event_time AS DATE) AS date
FROM v
"""
_LAST_HOUR = """
SELECT zone, avg(vehicle_count) AS avg_vehicles, count(*) AS event_count FROM v
WHERE event_time >= TIMESTAMP '2024-01-15 11:00:00'
  AND event_time < TIMESTAMP '2024-01-15 12:00:00'
GROUP BY zone
"""
_HOURS = """
SELECT date_trunc('hour', event_time) AS window_start, zone,
       avg(vehicle_count) AS avg_vehicles, count(*) AS events
FROM v GROUP BY date_trunc('hour', event_time), zone
"""
_ROADS = """
SELECT 'Highway' AS road_type, 100 AS capacity, 120 AS max_speed
UNION ALL SELECT 'Avenue', 50, 60 UNION ALL SELECT 'Street', 20, 50
"""
_CHECKED = f"""
SELECT v.event_id, v.road_type,
       v.vehicle_count < 0 OR v.vehicle_count > d.capacity AS bad_count,
       v.average_speed < 5 OR v.average_speed * 10 > d.max_speed * 11 AS bad_speed,
       v.occupancy_rate < 0 OR v.occupancy_rate > 100 AS bad_occupancy,
       d.road_type IS NULL AS bad_road
FROM v LEFT JOIN ({_ROADS}) d ON v.road_type = d.road_type
"""
_ANY_BAD = "(bad_count OR bad_speed OR bad_occupancy OR bad_road)"
_REASON = """
CASE event_type WHEN 'error' THEN 'malformed' WHEN 'signup' THEN 'missing_zone'
     WHEN 'view' THEN 'bad_event_time' END
"""

_CONFLICTS = """
SELECT sensor_id, count(DISTINCT (road, road_type, zone)) AS combinations,
       count(DISTINCT road) AS road_ids, count(DISTINCT road_type) AS road_types,
       count(DISTINCT zone) AS zones
FROM (SELECT *, CASE WHEN user_id < 5 AND event_type = 'error' THEN 'R999'
                     ELSE road_id END AS road FROM v) t
GROUP BY sensor_id HAVING count(DISTINCT (road, road_type, zone)) > 1
"""

_QUERIES = {
    "traffic_by_zone": _TRAFFIC_BY_ZONE,
    "speed_by_road": _SPEED_BY_ROAD,
    "congestion_flag": f"SELECT event_id, coalesce({_CONGESTED}, false) AS is_congested FROM v",
    "congestion_alerts": _ALERTS,
    "hourly_stats": _HOURLY_STATS,
    "critical_zones": _CRITICAL_ZONES,
    "event_summary": _SUMMARY,
    "day_period_stats": """
SELECT CASE WHEN hour(event_time) BETWEEN 7 AND 9 OR hour(event_time) BETWEEN 17 AND 19 THEN 'rush'
            WHEN hour(event_time) BETWEEN 6 AND 22 THEN 'day' ELSE 'night' END AS day_period,
       avg(vehicle_count) AS avg_vehicles, count(*) AS event_count
FROM v GROUP BY 1
""",
    "panel_traffic_by_hour": _TRAFFIC_BY_HOUR,
    "panel_speed_by_road": f"{_SPEED_BY_ROAD} ORDER BY avg_speed DESC",
    "panel_traffic_by_zone": """
SELECT zone, avg(vehicle_count) AS avg_vehicles FROM v GROUP BY zone ORDER BY avg_vehicles DESC
""",
    "panel_critical_zones": f"{_CRITICAL_ZONES} ORDER BY congestion_count DESC, zone LIMIT 5",
    "panel_critical_top3": f"{_CRITICAL_ZONES} ORDER BY congestion_count DESC, zone LIMIT 3",
    "panel_latest_alerts": _LATEST_ALERTS,
    "hourly_preview": f"{_TRAFFIC_BY_HOUR} LIMIT 20",
    "gate_row_count": f"SELECT count(*) AS zones FROM ({_TRAFFIC_BY_ZONE}) t",
    "implausible_events": f"""
SELECT event_id, road_type,
       concat_ws(',', CASE WHEN bad_count THEN 'vehicle_count' END,
                 CASE WHEN bad_speed THEN 'average_speed' END,
                 CASE WHEN bad_occupancy THEN 'occupancy_rate' END,
                 CASE WHEN bad_road THEN 'road_type' END) AS violations
FROM ({_CHECKED}) c WHERE {_ANY_BAD}
""",
    "plausibility_report": f"""
SELECT road_type, count(*) AS events, count(CASE WHEN {_ANY_BAD} THEN 1 END) AS implausible
FROM ({_CHECKED}) c GROUP BY road_type
""",
    "sensor_conflicts": _CONFLICTS,
    "encode_messages": """
SELECT event_id, sensor_id AS key,
       '{"sensor_id":"' || sensor_id || '","road_id":"' || road_id || '","road_type":"' ||
       road_type || '","zone":"' || zone || '","vehicle_count":' || vehicle_count ||
       ',"average_speed":' || average_speed || ',"occupancy_rate":' || occupancy_rate ||
       ',"event_time":"' || strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f') || '"}' AS value
FROM v
""",
    "decode_skip_invalid": f"""
SELECT event_id, sensor_id, road_id, road_type, zone, vehicle_count, average_speed,
       occupancy_rate, event_time
FROM v WHERE {_REASON} IS NULL
""",
    "rejected_records": f"SELECT event_id, {_REASON} AS reason FROM v WHERE {_REASON} IS NOT NULL",
    "document_events": """
SELECT sensor_id, road_id, road_type, zone, vehicle_count, average_speed, occupancy_rate,
       event_time
FROM v
""",
    "document_ranges": """
SELECT sensor_id, road_id, road_type, zone, vehicle_count, average_speed, occupancy_rate,
       event_time
FROM v
""",
    "lake_partition_counts": _PARTITION_COUNTS,
    "lake_pruned_scan": """
SELECT sensor_id, vehicle_count, average_speed, occupancy_rate FROM v
WHERE CAST(event_time AS DATE) = DATE '2024-01-03' AND zone = 'Downtown'
""",
    "lake_parquet_scan": _LAKE,
    "lake_conversion": _LAKE,
    "last_hour_by_zone": _LAST_HOUR,
    "lake_last_hour_by_zone": _LAST_HOUR,
    "stream_ingest": _PARTITION_COUNTS,
    "stream_rejects": f"""
SELECT {_REASON} AS reason, count(*) AS records FROM v WHERE {_REASON} IS NOT NULL GROUP BY 1
""",
    "stream_both_outputs": f"""
SELECT CAST(event_time AS DATE) AS date, zone, count(*) AS events, NULL::VARCHAR AS reason
FROM v WHERE {_REASON} IS NULL GROUP BY 1, 2
UNION ALL
SELECT NULL, NULL, count(*), {_REASON} FROM v WHERE {_REASON} IS NOT NULL GROUP BY {_REASON}
""",
    "ingest_counts": f"""
SELECT CAST(0 AS BIGINT) AS number, count(*) AS messages,
       count(CASE WHEN {_REASON} IS NULL THEN 1 END) AS accepted, count({_REASON}) AS rejected
FROM v
""",
    "stream_alerts": _ALERTS,
    "lake_stream_alerts": _ALERTS,
    "stream_hourly_by_zone": _HOURS,
    "stream_live": f"""
SELECT date_trunc('hour', event_time) AS window_start, zone, count(*) AS events,
       count(CASE WHEN {_CONGESTED} THEN 1 END) AS alerts
FROM v GROUP BY 1, 2
""",
    "ingest_report": """
SELECT CASE WHEN event_time < TIMESTAMP '2024-01-15 12:00:00' THEN 0 ELSE 1 END AS batch,
       CAST(event_time AS DATE) AS date, zone, count(*) AS events
FROM v GROUP BY 1, 2, 3
""",
    "stream_closed_hours": f"""
SELECT * FROM ({_HOURS}) h WHERE window_start + INTERVAL 1 HOUR <=
    (SELECT max(event_time) - INTERVAL 10 MINUTE FROM v)
""",
    "stored_traffic_by_zone": _TRAFFIC_BY_ZONE,
    "stored_speed_by_road": _SPEED_BY_ROAD,
    "stored_congestion_alerts": _ALERTS,
    "stored_hourly_stats": _HOURLY_STATS,
    "stored_critical_zones": _CRITICAL_ZONES,
    "stored_latest_alerts": _LATEST_ALERTS,
    "stored_panel_sql": _TRAFFIC_BY_HOUR,
    "lake_to_panel": f"{_CRITICAL_ZONES} ORDER BY congestion_count DESC, zone LIMIT 5",
    "refresh_one_date": _SUMMARY,
    "refresh_shrunk_date": f"""
SELECT CAST(event_time AS DATE) AS date, count(*) AS events,
       count(CASE WHEN {_CONGESTED} THEN 1 END) AS congested,
       count(CASE WHEN {_CONGESTED} THEN 1 END) AS alerts
FROM v WHERE CAST(event_time AS DATE) <> DATE '2024-01-16'
  AND (CAST(event_time AS DATE) <> DATE '2024-01-15' OR NOT coalesce({_CONGESTED}, false))
GROUP BY CAST(event_time AS DATE)
""",
    "follow_lake": _SUMMARY,
    "follow_compacted": _SUMMARY,
    "stream_late_hours": """
SELECT date_trunc('hour', event_time) AS window_start, zone,
       CASE WHEN event_time IS NULL OR event_time < TIMESTAMP '2024-01-15 00:00:00' THEN 'late'
            WHEN date_trunc('hour', event_time) + INTERVAL 1 HOUR <=
                 (SELECT max(event_time) - INTERVAL 10 MINUTE FROM v) THEN 'closed'
            ELSE 'open' END AS part,
       CAST(sum(vehicle_count) AS BIGINT) AS vehicles, count(*) AS events
FROM v GROUP BY 1, 2, 3
""",
    "stream_late_hours_added": _HOURS,
    "follow_conflicts": _CONFLICTS,
    "unknown_fields": """
SELECT CAST(event_time AS DATE) AS date, 'lane' AS field, 'BIGINT' AS type, count(*) AS messages
FROM v WHERE event_type = 'click' GROUP BY 1
""",
    "stored_pinned_version": f"""
SELECT zone, congestion_count, congestion_count AS alerts FROM ({_CRITICAL_ZONES}) z
""",
}


def all_sql() -> dict[str, str]:
    return {name: f"WITH v AS ({_V}) {sql}" for name, sql in _QUERIES.items()}
