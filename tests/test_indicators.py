"""The five indicators and derived statistics on the sample events."""

from __future__ import annotations

from datetime import datetime

import pytest
from samples import GOLDEN, rows

from roadpulse.functions.traffic import congestion_flag
from roadpulse.operators import kpis, panels, summary
from roadpulse.operators.ingest import typed
from roadpulse.plans.refresh import compute_kpis
from roadpulse.schema import EVENT, KPI_SCHEMAS, RAW_EVENT

EXPECTED = {
    "traffic_by_zone": {
        ("Suburbs", 81.0, 1),
        ("Downtown", 58.5, 2),
        ("Industrial", 31.0, 1),
        ("Residential-North", 15.0, 1),
    },
    "speed_by_road": {("Highway", 50.0), ("Avenue", 33.0), ("Street", 22.0)},
    "congestion_alerts": {
        ("Downtown", "Highway", 30, 74.5, datetime(2026, 1, 2, 8, 31)),
        ("Residential-North", "Street", 22, 91.5, datetime(2026, 1, 2, 8, 44)),
        ("Downtown", "Avenue", 18, 86.0, datetime(2026, 1, 2, 18, 10)),
    },
    "hourly_stats": {
        (8, 36.0, 33.333333333333336),
        (14, 81.0, 70.0),
        (18, 55.0, 18.0),
    },
    "critical_zones": {
        ("Downtown", 2),
        ("Residential-North", 1),
        ("Industrial", 0),
        ("Suburbs", 0),
    },
}


@pytest.mark.parametrize("name", list(EXPECTED))
def test_direct(golden, name):
    assert rows(getattr(kpis, name)(golden)) == EXPECTED[name]


@pytest.mark.parametrize("name", list(EXPECTED))
def test_from_one_summary(golden, name):
    table = compute_kpis(golden)[name]
    assert rows(table) == EXPECTED[name]
    assert [(f.name, f.dataType) for f in table.schema] == [
        (f.name, f.dataType) for f in KPI_SCHEMAS[name]
    ]


def test_text_times_work_as_well(spark):
    raw = spark.createDataFrame(GOLDEN, RAW_EVENT)
    assert rows(kpis.hourly_stats(raw)) == EXPECTED["hourly_stats"]
    assert rows(kpis.congestion_alerts(raw)) == EXPECTED["congestion_alerts"]


@pytest.mark.parametrize(
    "speed, occupancy, flag",
    [
        (35, 78.5, True),
        (40, 70.0, False),
        (39, 70.0, True),
        (40, 70.01, True),
        (None, 71.0, True),
        (None, 10.0, False),
        (39, None, True),
        (40, None, False),
        (None, None, False),
    ],
)
def test_congestion_boundaries(spark, speed, occupancy, flag):
    event = spark.createDataFrame(
        [(speed, occupancy)], "average_speed BIGINT, occupancy_rate DOUBLE"
    )
    assert event.select(congestion_flag()).first()[0] is flag
    assert event.selectExpr("*", "'z' AS zone").transform(kpis.critical_zones).first()[1] == flag


def test_thresholds_are_parameters(golden):
    assert kpis.congestion_alerts(golden, speed_limit=80, occupancy_limit=100).count() == 5
    assert rows(kpis.flag_congestion(golden, 0, 100).select("is_congested")) == {(False,)}


def test_null_readings_and_times(spark):
    events = spark.createDataFrame(
        [
            ("S1", "R1", "Street", "A", None, None, None, None),
            ("S1", "R1", "Street", "A", 4, 30, 1.0, datetime(2026, 1, 2, 3)),
            ("S1", "R1", None, None, 6, None, 90.0, datetime(2026, 1, 2, 3)),
        ],
        EVENT,
    )
    expected = {
        "traffic_by_zone": {("A", 4.0, 2), (None, 6.0, 1)},
        "speed_by_road": {("Street", 30.0), (None, None)},
        "hourly_stats": {(None, None, None), (3, 5.0, 30.0)},
        "critical_zones": {("A", 1), (None, 1)},
    }
    together = compute_kpis(events)
    for name, result in expected.items():
        assert rows(getattr(kpis, name)(events)) == result
        assert rows(together[name]) == result
    assert rows(kpis.day_period_stats(events)) == {("night", 5.0, 2), (None, None, 1)}


def test_absurd_readings_do_not_stop_the_job(spark):
    huge = 2**63 - 1
    events = spark.createDataFrame(
        [("S1", "R1", "Street", "A", huge, huge, 1.0, datetime(2026, 1, 2, 3))] * 3, EVENT
    )
    assert compute_kpis(events)["traffic_by_zone"].first()["avg_vehicles"] == float(huge)


def test_day_periods(golden, spark):
    counts = {(r.day_period, r.event_count) for r in kpis.day_period_stats(golden).collect()}
    assert counts == {("rush", 4), ("day", 1)}
    hours = spark.range(24).selectExpr(
        "make_timestamp_ntz(2026, 1, 2, CAST(id AS INT), 59, 59.999999) AS event_time",
        "id AS vehicle_count",
        "id AS hour",
    )
    from roadpulse.functions.traffic import day_period

    found = {r.hour: r.period for r in hours.select("hour", day_period().alias("period")).collect()}
    rush = {7, 8, 9, 17, 18, 19}
    day = set(range(6, 23)) - rush
    assert found == {
        h: "rush" if h in rush else "day" if h in day else "night" for h in range(24)
    }


def test_hours_do_not_move_with_the_session_zone(spark, golden):
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "America/New_York")
    events = typed(other.createDataFrame(GOLDEN, RAW_EVENT))
    assert rows(kpis.hourly_stats(events)) == EXPECTED["hourly_stats"]


def test_panels(golden):
    tables = compute_kpis(golden)
    by_hour = [tuple(r) for r in panels.traffic_by_hour(tables["hourly_stats"]).collect()]
    assert by_hour == [(8, 36.0), (14, 81.0), (18, 55.0)]
    by_road = [tuple(r) for r in panels.speed_by_road(tables["speed_by_road"]).collect()]
    assert by_road == [("Highway", 50.0), ("Avenue", 33.0), ("Street", 22.0)]
    by_zone = [tuple(r) for r in panels.traffic_by_zone(tables["traffic_by_zone"]).collect()]
    assert by_zone == [
        ("Suburbs", 81.0),
        ("Downtown", 58.5),
        ("Industrial", 31.0),
        ("Residential-North", 15.0),
    ]
    critical = [tuple(r) for r in panels.critical_zones(tables["critical_zones"], 3).collect()]
    assert critical == [("Downtown", 2), ("Residential-North", 1), ("Industrial", 0)]
    latest = panels.latest_alerts(tables["congestion_alerts"]).collect()
    assert [r.average_speed for r in latest] == [18, 22, 30]
    assert panels.preview(golden, 2).count() == 2


def test_newest_alert_dates(spark):
    table = spark.createDataFrame(
        [("2026-01-01", 5), ("2026-01-02", 0), ("2026-01-03", 2), ("2026-01-04", 1), (None, 9)],
        "day STRING, congested BIGINT",
    ).selectExpr("CAST(day AS DATE) AS date", "congested")

    def since(k):
        found = summary.newest_alert_dates(table, k).first()["since"]
        return found and found.day

    assert [since(k) for k in (1, 2, 3, 4, 8, 9)] == [4, 3, 3, 1, 1, None]
