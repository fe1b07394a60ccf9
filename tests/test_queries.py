"""Every registered query against its SQL on DuckDB, and the shape of the plans."""

from __future__ import annotations

import os

import __spark_entry__ as contract
import pytest
from compare import assert_same, duck
from samples import plan

from roadpulse.operators import checks, kpis
from roadpulse.plans import oracle, registry
from roadpulse.sinks.lake import write_lake
from roadpulse.sources.lake import read_lake

DATA = "/root/testdata"
SCALES = [scale for scale in ("sf0.001", "sf0.01") if os.path.isdir(f"{DATA}/{scale}")]
QUERIES = registry.all_queries()
SQL = oracle.all_sql()
WRITING = ("stream_", "ingest_", "stored_", "lake_", "refresh_", "follow_", "document_", "unknown_")
BATCH = [n for n in QUERIES if not n.startswith(WRITING)]


@pytest.fixture(scope="module")
def connections():
    return {scale: duck(f"{DATA}/{scale}") for scale in SCALES}


def test_all_are_registered():
    assert QUERIES.keys() <= contract.queries().keys() and SQL.items() <= contract.oracle_sql().items()


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("scale", SCALES)
@pytest.mark.parametrize("name", list(QUERIES))
def test_same_as_sql(spark, connections, name, scale):
    found = assert_same(QUERIES[name](spark, f"{DATA}/{scale}"), connections[scale], SQL[name])
    assert found > 0


def test_entry(spark):
    assert contract.entry(spark).columns == ["zone", "avg_vehicles", "event_count"]


@pytest.mark.parametrize("name", BATCH)
def test_no_python_in_the_plan(spark, name):
    text = plan(QUERIES[name](spark, f"{DATA}/sf0.001"))
    for node in ("EvalPython", "InPandas", "InArrow", "CartesianProduct", "NestedLoop"):
        assert node not in text


def test_top_k_without_a_global_sort(spark):
    for name in ("panel_critical_zones", "panel_latest_alerts"):
        text = plan(QUERIES[name](spark, f"{DATA}/sf0.001"))
        assert "TakeOrderedAndProject" in text
        assert "rangepartitioning" not in text


def test_predicates_reach_the_scan(spark, tmp_path):
    root = str(tmp_path / "lake")
    write_lake(registry.road_events(spark, f"{DATA}/sf0.001"), root, "parquet")
    lake = read_lake(spark, root, "parquet")
    alerts = plan(kpis.congestion_alerts(lake))
    assert (
        "PushedFilters: [Or(LessThan(average_speed,40),GreaterThan(occupancy_rate,70.0))]" in alerts
    )
    assert "sensor_id" not in alerts.split("ReadSchema")[1].split("\n")[0]
    odd = plan(checks.implausible_events(lake))
    assert "GreaterThan(average_speed,132)" in odd and "Join" not in odd
    zones = plan(kpis.traffic_by_zone(lake))
    assert "ReadSchema: struct<vehicle_count:bigint>" in zones
    assert "partial_avg" in zones


def test_last_hour_reaches_the_scan(spark):
    text = plan(registry.last_hour_by_zone(spark, f"{DATA}/sf0.001"))
    assert "GreaterThanOrEqual(ts,2024-01-15T11:00)" in text
