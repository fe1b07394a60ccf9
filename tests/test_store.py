"""Stored tables, checks and whole runs."""

from __future__ import annotations

from datetime import date

import pytest
from samples import GOLDEN, plan, rows
from test_indicators import EXPECTED

from roadpulse.jobs import process, verify
from roadpulse.operators import checks, kpis, panels
from roadpulse.operators.ingest import route, typed
from roadpulse.plans import follow, refresh
from roadpulse.plans.follow import add_batch, start_following
from roadpulse.schema import EVENT, KPI_NAMES, KPI_SCHEMAS, RAW_EVENT
from roadpulse.sinks.lake import write_lake
from roadpulse.sinks.store import compact
from roadpulse.sources import versions
from roadpulse.sources.store import (
    read_summary,
    read_table,
    read_tables,
    read_totals,
    register_views,
)

PANELS = {
    "SELECT hour, AVG(avg_vehicles) FROM hourly_stats GROUP BY hour ORDER BY hour": [
        (8, 36.0), (14, 81.0), (18, 55.0),
    ],
    "SELECT road_type, avg_speed FROM speed_by_road ORDER BY avg_speed DESC": [
        ("Highway", 50.0), ("Avenue", 33.0), ("Street", 22.0),
    ],
    "SELECT zone, avg_vehicles FROM traffic_by_zone ORDER BY avg_vehicles DESC": [
        ("Suburbs", 81.0), ("Downtown", 58.5), ("Industrial", 31.0), ("Residential-North", 15.0),
    ],
}


@pytest.fixture
def paths(golden, tmp_path):
    write_lake(golden, str(tmp_path / "lake"))
    return refresh.Refresh(lake=str(tmp_path / "lake"), store=str(tmp_path / "store"))


def test_two_runs_leave_the_same_tables(spark, paths):
    for _ in range(2):
        counts = refresh.run(spark, paths)
        assert counts == {name: len(EXPECTED[name]) for name in KPI_NAMES}
        for name, table in read_tables(spark, paths.store).items():
            assert table.schema == KPI_SCHEMAS[name]
            assert table.count() == len(EXPECTED[name])
            assert rows(table) == EXPECTED[name]


def test_dashboard_sql_runs_unchanged(spark, paths):
    refresh.run(spark, paths)
    session = spark.newSession()
    register_views(session, paths.store)
    for sql, expected in PANELS.items():
        assert [tuple(r) for r in session.sql(sql).collect()] == expected
    top = session.sql(
        "SELECT zone, congestion_count FROM critical_zones ORDER BY congestion_count DESC LIMIT 5"
    )
    assert [r.zone for r in top.collect()][:2] == ["Downtown", "Residential-North"]
    latest = session.sql(
        "SELECT zone, road_type, average_speed, event_time FROM congestion_alerts "
        "ORDER BY event_time DESC LIMIT 10"
    )
    assert [r.average_speed for r in latest.collect()] == [18, 22, 30]


def _more(spark, *days):
    raw = [(*row[:-1], f"2026-01-{day:02d}{row[-1][10:]}") for day in days for row in GOLDEN]
    return typed(spark.createDataFrame(raw, RAW_EVENT))


def test_refreshing_dates_equals_a_full_run(spark, tmp_path):
    lake, store, full = (str(tmp_path / name) for name in ("lake", "store", "full"))
    write_lake(_more(spark, 1, 2, 3), lake)
    refresh.run(spark, refresh.Refresh(lake, store))
    write_lake(_more(spark, 3, 4), lake)
    refresh.run(spark, refresh.Refresh(lake, store), [date(2026, 1, 3), date(2026, 1, 4)])
    refresh.run(spark, refresh.Refresh(lake, full))
    assert rows(read_summary(spark, store)) == rows(read_summary(spark, full))
    for name, table in read_tables(spark, full).items():
        stored = read_tables(spark, store)[name]
        assert sorted(map(str, stored.collect())) == sorted(map(str, table.collect()))


def test_a_refreshed_date_that_shrinks_keeps_no_rows(spark, tmp_path):
    store, full = str(tmp_path / "store"), str(tmp_path / "full")
    refresh.store_kpis(spark, _more(spark, 1, 2, 3), store)
    left = _more(spark, 1).union(_more(spark, 2).filter("sensor_id = 'S004'"))
    refresh.store_kpis(spark, left, store, [date(2026, 1, 2), date(2026, 1, 3)])
    refresh.store_kpis(spark, left, full)
    _same_tables(spark, full, store)


def test_a_store_is_kept_one_way(spark, tmp_path):
    lake, store, full = (str(tmp_path / name) for name in ("lake", "store", "full"))
    paths = refresh.Refresh(lake, store)
    write_lake(_more(spark, 1, 2), lake)
    refresh.run(spark, paths)
    start_following(spark, paths).awaitTermination()  # takes the store over
    for dates in (None, [date(2026, 1, 2)]):
        with pytest.raises(refresh.FollowedStore, match="follows a lake"):
            refresh.run(spark, paths, dates)
    write_lake(_more(spark, 2), lake)
    start_following(spark, paths).awaitTermination()
    refresh.run(spark, refresh.Refresh(lake, full))
    _same_tables(spark, full, store)


def test_a_batch_reads_totals_that_do_not_grow_with_dates(spark, tmp_path):
    store = str(tmp_path / "store")
    sizes = []
    for number, days in enumerate((range(1, 3), range(3, 20), range(20, 29), [28])):
        add_batch(spark, route(_more(spark, *days)), store, number)
        sizes.append(read_totals(spark, store).count())
    assert sizes == [5, 5, 5, 5]  # hour, zone and road type of the samples
    assert read_summary(spark, store).count() == 28 * 5


def _same_tables(spark, one, other):
    assert rows(read_summary(spark, one)) == rows(read_summary(spark, other))
    for name, table in read_tables(spark, one).items():
        found = read_tables(spark, other)[name]
        assert sorted(map(str, found.collect())) == sorted(map(str, table.collect()))


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_following_the_lake_equals_runs_over_it(spark, tmp_path, fmt):
    lake, store = str(tmp_path / "lake"), str(tmp_path / "store")
    paths = refresh.Refresh(lake, store, fmt)
    for number, days in enumerate([(1,), (1, 2), (3,), (1,), (2, 4, 5)]):
        write_lake(_more(spark, *days), lake, fmt)
        start_following(spark, paths).awaitTermination()
        full = str(tmp_path / f"full-{number}")
        refresh.run(spark, refresh.Refresh(lake, full, fmt))
        _same_tables(spark, full, store)
        newest = refresh.latest_alerts(spark, store).collect()
        assert newest == refresh.latest_alerts(spark, full).collect()
    start_following(spark, paths).awaitTermination()
    _same_tables(spark, full, store)


def test_a_batch_done_twice_counts_once(spark, tmp_path):
    store, full = str(tmp_path / "store"), str(tmp_path / "full")
    batches = [route(_more(spark, *days)) for days in ((1, 2), (2, 3), (1, 4), (4,))]
    for number, batch in enumerate(batches):
        for _ in range(2):
            add_batch(spark, batch, store, number)
    refresh.store_kpis(spark, _more(spark, 1, 2, 2, 3, 1, 4, 4), full)
    _same_tables(spark, full, store)


def test_a_batch_that_breaks_off_is_done_again(spark, tmp_path, monkeypatch):
    lake, store, full = (str(tmp_path / name) for name in ("lake", "store", "full"))
    paths = refresh.Refresh(lake, store)
    write_lake(_more(spark, 1, 2), lake)
    start_following(spark, paths).awaitTermination()
    write_lake(_more(spark, 2, 3), lake)
    with monkeypatch.context() as broken:
        broken.setattr(follow, "write_indicators", lambda *a: 1 / 0)
        with pytest.raises(Exception, match="division by zero"):
            start_following(spark, paths).awaitTermination()
    start_following(spark, paths).awaitTermination()
    refresh.run(spark, refresh.Refresh(lake, full))
    _same_tables(spark, full, store)


def test_following_with_events_without_a_time(spark, golden, tmp_path):
    store, full = str(tmp_path / "store"), str(tmp_path / "full")
    timeless = golden.selectExpr(
        *[c for c in golden.columns if c != "event_time"],
        "CAST(NULL AS TIMESTAMP_NTZ) AS event_time",
    ).select(*golden.columns)
    for number, batch in enumerate((golden, timeless, timeless)):
        add_batch(spark, route(batch), store, number)
    refresh.store_kpis(spark, golden.union(timeless).union(timeless), full)
    _same_tables(spark, full, store)


def test_latest_alerts_open_few_dates(spark, tmp_path):
    store = str(tmp_path / "store")
    refresh.store_kpis(spark, _more(spark, *range(1, 10)), store)
    latest = refresh.latest_alerts(spark, store, 11)
    assert [(r.event_time.day, r.average_speed) for r in latest.collect()][:4] == [
        (9, 18), (9, 22), (9, 30), (8, 18),
    ]
    text = plan(latest)
    assert "PartitionFilters" in text and "TakeOrderedAndProject" in text
    assert refresh.latest_alerts(spark, store, 100).count() == 27
    # Files of the first five dates are no longer readable, and are not read.
    spoiled = list((tmp_path / "store" / "congestion_alerts").glob("version=*/date=2026-01-0[1-5]/part-*"))
    for file in spoiled:
        file.write_bytes(b"spoiled")
    spark.catalog.clearCache()
    assert spoiled and len(refresh.latest_alerts(spark, store, 11).collect()) == 11
    with pytest.raises(Exception, match="not a Parquet file"):
        refresh.latest_alerts(spark, store, 100).collect()


def test_latest_alerts_of_the_dashboard_open_no_date(spark, tmp_path):
    store = str(tmp_path / "store")
    refresh.store_kpis(spark, _more(spark, *range(1, 10)), store)
    expected = refresh.latest_alerts(spark, store, 11).collect()[:10]
    for file in (tmp_path / "store" / "congestion_alerts").glob("version=*/date=*/part-*"):
        file.write_bytes(b"spoiled")
    assert refresh.latest_alerts(spark, store).collect() == expected
    assert refresh.latest_alerts(spark, store, 4).collect() == expected[:4]


def test_latest_alerts_under_ties_and_refreshed_dates(spark, tmp_path):
    store, full, followed = (str(tmp_path / x) for x in ("store", "full", "followed"))
    days = [1, 2, 2, 2, 2, 2, 3, 3]
    refresh.store_kpis(spark, _more(spark, *days), store)
    left = _more(spark, *days).filter("event_time < TIMESTAMP_NTZ '2026-01-03 10:00:00'")
    refresh.store_kpis(spark, left, store, [date(2026, 1, 3)])
    refresh.store_kpis(spark, left, full)
    for number, day in enumerate([3, 2, 1]):
        part = left.filter(f"date(event_time) = DATE '2026-01-0{day}'")
        add_batch(spark, route(part), followed, number)
    plain = [tuple(x) for x in panels.latest_alerts(kpis.congestion_alerts(left), 10).collect()]
    for place in (store, full, followed):
        assert [tuple(x) for x in refresh.latest_alerts(spark, place).collect()] == plain


def test_a_reader_between_two_table_writes_sees_one_version(spark, tmp_path, monkeypatch):
    store, old, seen = str(tmp_path / "store"), str(tmp_path / "old"), []
    refresh.store_kpis(spark, _more(spark, 1, 2), store)
    refresh.store_kpis(spark, _more(spark, 1, 2), old)
    write = versions.Draft.write_small

    def write_and_look(draft, table, name):
        write(draft, table, name)
        found = read_tables(spark, store)
        seen.append({x: sorted(map(str, table.collect())) for x, table in found.items()})

    with monkeypatch.context() as watched:
        watched.setattr(versions.Draft, "write_small", write_and_look)
        refresh.store_kpis(spark, _more(spark, 2, 3, 3), store)
    expected = {x: sorted(map(str, table.collect())) for x, table in read_tables(spark, old).items()}
    assert len(seen) == 5 and all(x == expected for x in seen)
    assert read_summary(spark, store).filter("date = DATE '2026-01-01'").count() == 0


def test_a_run_that_breaks_off_loses_nothing(spark, tmp_path, monkeypatch):
    store, old = str(tmp_path / "store"), str(tmp_path / "old")
    refresh.store_kpis(spark, _more(spark, 1, 2), store)
    refresh.store_kpis(spark, _more(spark, 1, 2), old)
    for name in ("write_summary", "write_alerts", "write_indicators"):
        for dates in (None, [date(2026, 1, 2)]):
            with monkeypatch.context() as broken:
                broken.setattr(refresh, name, lambda *a: 1 / 0)
                with pytest.raises(ZeroDivisionError):
                    refresh.store_kpis(spark, _more(spark, 2, 3), store, dates)
            _same_tables(spark, old, store)
    refresh.store_kpis(spark, _more(spark, 1, 1), store)
    assert versions.find(spark, store).number == 2
    labels = {x.name for x in (tmp_path / "store").glob("*/version=*")}
    assert len(labels) == 2  # nothing is left of the runs that broke off


def test_a_pinned_version_stays_readable_for_a_while(spark, tmp_path):
    store = str(tmp_path / "store")
    first = refresh.store_kpis(spark, _more(spark, 1, 2), store)
    before = sorted(map(str, read_table(spark, store, "congestion_alerts", first).collect()))
    for _ in range(versions.KEPT):
        refresh.store_kpis(spark, _more(spark, 2, 3, 4), store, [date(2026, 1, 2)])
    assert sorted(map(str, read_table(spark, store, "congestion_alerts", first.number).collect())) == before
    refresh.store_kpis(spark, _more(spark, 5), store)
    with pytest.raises(versions.StoreMissing, match="version 1"):
        read_table(spark, store, "congestion_alerts", first.number)
    with pytest.raises(versions.StoreMissing):
        read_summary(spark, str(tmp_path / "none"))


def test_two_writers_do_not_mix(spark, tmp_path):
    store = str(tmp_path / "store")
    refresh.store_kpis(spark, _more(spark, 1), store)
    slow = versions.Draft(spark, store, versions.find(spark, store))
    refresh.store_kpis(spark, _more(spark, 2), store)
    slow.write_small(_more(spark, 1).selectExpr("zone", "0 AS congestion_count"), "critical_zones")
    with pytest.raises(versions.VersionTaken):
        slow.commit()
    assert {r.congestion_count for r in read_table(spark, store, "critical_zones").collect()} == {0, 1, 2}


def _parts(store):
    return {x: len(list(store.glob(f"{x}/version=*/date=*/part-*"))) for x in ("event_summary", "congestion_alerts")}


def test_files_of_a_followed_store_are_bounded_by_dates(spark, tmp_path, monkeypatch):
    store, full = tmp_path / "store", str(tmp_path / "full")
    monkeypatch.setattr(versions, "KEPT", 0)
    batches = [_more(spark, 1 + number % 2, 3) for number in range(14)]
    for number, batch in enumerate(batches):
        add_batch(spark, route(batch).coalesce(1), str(store), number)
        before = read_summary(spark, str(store)).collect()
        alerts = sorted(map(str, read_table(spark, str(store), "congestion_alerts").collect()))
        if compact(spark, str(store), most_parts=3) is not None:
            assert sorted(map(str, before)) == sorted(map(str, read_summary(spark, str(store)).collect()))
            assert alerts == sorted(map(str, read_table(spark, str(store), "congestion_alerts").collect()))
        assert all(x <= 3 * 4 for x in _parts(store).values())
    refresh.store_kpis(spark, _more(spark, *([1, 2] * 7 + [3] * 14)), full)
    _same_tables(spark, full, str(store))


def test_large_parts_are_not_written_again(spark, tmp_path):
    store = str(tmp_path / "store")
    for number in range(4):
        add_batch(spark, route(_more(spark, 1)), store, number)
    held = versions.find(spark, store).dated["event_summary"]["2026-01-01"]
    assert len(held) == 4 and compact(spark, store, most_parts=3, small=1) is None
    assert compact(spark, store, most_parts=4) is None
    joined = compact(spark, store, most_parts=3)
    assert [len(x["2026-01-01"]) for x in joined.dated.values()] == [1, 1]
    assert (joined.stream, joined.batch) == ("", 3)
    add_batch(spark, route(_more(spark, 1)), store, 4)
    assert read_summary(spark, store).agg({"events": "sum"}).first()[0] == 25


def test_a_stream_does_not_go_on_with_the_store_of_another(spark, tmp_path):
    store = str(tmp_path / "store")
    add_batch(spark, route(_more(spark, 1)), store, 0, "one")
    with pytest.raises(refresh.FollowedStore, match="batches before 1"):
        add_batch(spark, route(_more(spark, 1)), store, 1, "other")
    add_batch(spark, route(_more(spark, 2)), store, 0, "other")
    assert read_summary(spark, store).agg({"events": "sum"}).first()[0] == 5


def test_gate(spark, golden, tmp_path):
    assert checks.require_rows(golden, "events") == 5
    with pytest.raises(checks.EmptyTable, match="events"):
        checks.require_rows(golden.limit(0), "events")
    (tmp_path / "lake").mkdir()
    with pytest.raises(checks.EmptyTable):
        refresh.run(spark, refresh.Refresh(str(tmp_path / "lake"), str(tmp_path / "store")))


def test_a_day_without_alerts_passes(spark, golden, tmp_path):
    store = str(tmp_path / "store")
    refresh.store_kpis(spark, golden.filter("sensor_id = 'S004'"), store)
    assert refresh.verify(spark, store)["congestion_alerts"] == 0
    assert refresh.latest_alerts(spark, store).count() == 0


def test_events_without_a_time_can_be_refreshed(spark, golden, tmp_path):
    store = str(tmp_path / "store")
    timeless = golden.selectExpr(
        *[c for c in golden.columns if c != "event_time"],
        "CAST(NULL AS TIMESTAMP_NTZ) AS event_time",
    ).select(*golden.columns)
    both = golden.union(timeless)
    refresh.store_kpis(spark, both, store)
    before = {name: rows(table) for name, table in read_tables(spark, store).items()}
    assert {r[0] for r in before["hourly_stats"]} == {8, 14, 18, None}
    refresh.store_kpis(spark, both, store, [None, date(2026, 1, 2)])
    assert {name: rows(table) for name, table in read_tables(spark, store).items()} == before
    assert len(refresh.latest_alerts(spark, store, 6).collect()) == 6
    assert all(r.event_time for r in refresh.latest_alerts(spark, store, 3).collect())


def test_jobs(spark, paths, capsys):
    process.main(["--lake", paths.lake, "--store", paths.store])
    assert verify.main(["--store", paths.store])["traffic_by_zone"] == 4
    assert "traffic_by_zone: 4 rows" in capsys.readouterr().out


def test_implausible_events(spark, golden):
    found = checks.implausible_events(golden)
    assert [(r.sensor_id, r.violations) for r in found.collect()] == [("S005", "vehicle_count")]
    edge = [
        ("ok", "R", "Highway", "A", 100, 132, 100.0, None),
        ("ok", "R", "Avenue", "A", 50, 66, 0.0, None),
        ("ok", "R", "Street", "A", 0, 5, 0.0, None),
        ("ok", "R", "Street", "A", None, None, None, None),
        ("fast", "R", "Street", "A", 20, 56, 100.0, None),
        ("slow", "R", "Avenue", "A", 51, 4, 100.01, None),
        ("lost", "R", "Path", "A", 1000, 1000, -1.0, None),
        ("none", "R", None, "A", 1, 10, 1.0, None),
        ("less", "R", "Street", "A", -1, None, None, None),
    ]
    events = spark.createDataFrame(edge, EVENT)
    assert {(r.sensor_id, r.violations) for r in checks.implausible_events(events).collect()} == {
        ("fast", "average_speed"),
        ("slow", "vehicle_count,average_speed,occupancy_rate"),
        ("lost", "occupancy_rate,road_type"),
        ("none", "road_type"),
        ("less", "vehicle_count"),
    }
    assert rows(checks.plausibility_report(golden)) == {
        ("Highway", 2, 0),
        ("Avenue", 2, 1),
        ("Street", 1, 0),
    }


def test_sensor_conflicts(spark, golden):
    assert checks.sensor_conflicts(golden).count() == 0
    moved = golden.filter("sensor_id = 'S001'").selectExpr(
        "sensor_id", "'R999' AS road_id", "road_type", "'Suburbs' AS zone", "vehicle_count",
        "average_speed", "occupancy_rate", "event_time",
    )
    found = checks.sensor_conflicts(golden.union(golden).union(moved))
    assert rows(found) == {("S001", 2, 2, 1, 2)}


def test_alerts_stay_equal_with_and_without_a_date_column(golden):
    assert rows(kpis.congestion_alerts(route(golden))) == rows(kpis.congestion_alerts(golden))
