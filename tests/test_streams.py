"""Streams: equal to batch, restart-safe, late data, rejects, open and closed hours."""

from __future__ import annotations

import os
from datetime import date, datetime

import pytest
from samples import GOLDEN, message, rows

from roadpulse.jobs import convert, ingest, process, publish, refresh
from roadpulse.jobs import live as live_job
from roadpulse.operators import checks, drift, kpis
from roadpulse.operators.ingest import partition_counts, typed
from roadpulse.operators.windows import added_hours, hourly_by_zone, hourly_sums
from roadpulse.plans.follow import start_following
from roadpulse.plans.refresh import Refresh
from roadpulse.schema import EVENT_COLUMNS, KPI_NAMES, RAW_EVENT
from roadpulse.sinks.lake import make_folder, write_lake
from roadpulse.sources import commits
from roadpulse.sources.folder import Folder
from roadpulse.sources.lake import (
    LakeOfAnotherWriter,
    read_extra,
    read_lake,
    read_rejects,
    stream_lake,
)
from roadpulse.sources.messages import message_files
from roadpulse.sources.store import read_table
from roadpulse.streaming import ingest as streaming_ingest
from roadpulse.streaming import live
from roadpulse.streaming.ingest import (
    ONCE,
    start_conversion,
    start_ingest,
    start_rejects,
    start_report,
)
from roadpulse.streaming.session import scratch, stream_session

MESSAGES = [message(**dict(zip(EVENT_COLUMNS, row))) for row in GOLDEN]


@pytest.fixture
def inbox(tmp_path):
    folder = tmp_path / "inbox"
    folder.mkdir()

    def add(name, lines):
        (folder / name).write_text("\n".join(lines) + "\n")

    add.path = str(folder)
    return add


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_ingest_restart_and_late_events(spark, golden, inbox, tmp_path, fmt):
    root, checkpoint = str(tmp_path / "lake"), str(tmp_path / "checkpoint")

    def run():
        messages = message_files(spark, inbox.path, files_per_batch=1)
        query = start_ingest(messages, root, checkpoint, fmt, trigger=ONCE)
        query.awaitTermination()
        return query

    inbox("1.txt", MESSAGES[:3] + ["{bad", ""])
    query = run()
    counted = [p.observedMetrics["ingest"] for p in query.recentProgress if p.numInputRows]
    assert sum(m.messages for m in counted) == 5
    assert sum(m.accepted for m in counted) == 3
    inbox("2.txt", MESSAGES[3:] + ["5"])
    run()
    assert rows(read_lake(spark, root, fmt).select(*EVENT_COLUMNS)) == rows(golden)
    run()
    assert read_lake(spark, root, fmt).count() == 5
    inbox("3.txt", [message(event_time="2025-12-31T23:59:59")])
    run()
    late = partition_counts(read_lake(spark, root, fmt)).filter("date < DATE '2026-01-01'")
    assert rows(late) == {(date(2025, 12, 31), "Downtown", 1)}
    folders = [d for d in os.listdir(root) if d.startswith("date=")]
    assert sorted(folders) == ["date=2025-12-31", "date=2026-01-02"]


def test_rejects(spark, inbox, tmp_path):
    inbox("1.txt", [*MESSAGES, "{bad", "", "[1]", message(zone=""), message(event_time="x")])
    path = str(tmp_path / "rejects")
    messages = message_files(spark, inbox.path)
    start_rejects(messages, path, str(tmp_path / "c"), trigger=ONCE).awaitTermination()
    assert rows(spark.read.parquet(path).select("value", "reason")) == {
        ("{bad", "malformed"),
        ("", "blank"),
        ("[1]", "not_object"),
        (message(zone=""), "missing_zone"),
        (message(event_time="x"), "bad_event_time"),
    }


def test_alerts_from_the_lake(spark, golden, inbox, tmp_path):
    inbox("1.txt", MESSAGES)
    root, path = str(tmp_path / "lake"), str(tmp_path / "alerts")
    messages = message_files(spark, inbox.path)
    start_ingest(messages, root, str(tmp_path / "c1"), trigger=ONCE).awaitTermination()
    for _ in range(2):
        events = stream_lake(spark, root)
        live.start_alerts(events, path, str(tmp_path / "c2"), trigger=ONCE).awaitTermination()
    alerts = spark.read.parquet(path).drop("date")
    assert alerts.count() == 3
    assert rows(alerts) == rows(kpis.congestion_alerts(golden))


def test_ingest_into_a_lake_of_other_files(spark, golden, inbox, tmp_path):
    """A lake may be filled by ingest and by batches; one that a file stream's log hides is refused."""
    inbox("1.txt", MESSAGES)
    lake, logged = str(tmp_path / "lake"), str(tmp_path / "logged")

    def run(root):
        messages = message_files(spark, inbox.path)
        start_ingest(messages, root, f"{root}-c", trigger=ONCE).awaitTermination()

    write_lake(golden, lake)
    for count in (10, 10):
        run(lake)
        assert read_lake(spark, lake).count() == count
    write_lake(golden, lake)
    assert read_lake(spark, lake).count() == 15
    events = stream_lake(spark, lake)
    start_conversion(events, logged, f"{logged}-c1", trigger=ONCE).awaitTermination()
    for write in (lambda: run(logged), lambda: write_lake(golden, logged)):
        with pytest.raises(LakeOfAnotherWriter, match="logged"):
            write()
    full = str(tmp_path / "full")
    write_lake(golden, full, "parquet")
    with pytest.raises(LakeOfAnotherWriter, match="full holds"):
        start_conversion(events, full, str(tmp_path / "c2"), trigger=ONCE)


class Ingest:
    """Ingest of an inbox, run by run, that can be made to break off."""

    def __init__(self, spark, inbox, tmp_path, monkeypatch):
        self.spark, self.inbox, self.monkeypatch = spark, inbox, monkeypatch
        self.lake, self.rejects, self.checkpoint = (str(tmp_path / x) for x in ("lake", "rejects", "c"))

    def run(self):
        messages = message_files(self.spark, self.inbox.path, files_per_batch=1)
        query = start_ingest(messages, self.lake, self.checkpoint, trigger=ONCE, rejects=self.rejects)
        query.awaitTermination()
        return query

    def break_off(self, where, name):
        """Runs with one function failing at its first call."""
        with self.monkeypatch.context() as broken:
            broken.setattr(where, name, lambda *a, **k: 1 / 0)
            with pytest.raises(Exception, match="division by zero"):
                self.run()

    def events(self):
        return read_lake(self.spark, self.lake).count() if os.path.isdir(self.lake) else 0

    def values(self):
        found = read_rejects(self.spark, self.rejects, self.lake) if os.path.isdir(self.rejects) else None
        return sorted(x.value for x in found.collect()) if found else []


@pytest.fixture
def ingest_runs(spark, inbox, tmp_path, monkeypatch):
    return Ingest(spark, inbox, tmp_path, monkeypatch)


def test_a_break_between_the_two_outputs(golden, inbox, ingest_runs):
    inbox("1.txt", [*MESSAGES[:3], "{bad"])
    ingest_runs.run()
    inbox("2.txt", [*MESSAGES[3:], "worse", ""])
    ingest_runs.break_off(streaming_ingest, "rejected")  # the lake is staged, the rejects are not
    assert ingest_runs.events() == 3 and ingest_runs.values() == ["{bad"]
    ingest_runs.break_off(commits, "commit")  # both are staged
    assert ingest_runs.events() == 3 and ingest_runs.values() == ["{bad"]
    for _ in range(2):
        ingest_runs.run()
        assert rows(read_lake(ingest_runs.spark, ingest_runs.lake).select(*EVENT_COLUMNS)) == rows(golden)
        assert ingest_runs.events() == 5 and ingest_runs.values() == ["", "worse", "{bad"]


def test_a_break_while_files_are_moved(inbox, ingest_runs, spark):
    inbox("1.txt", [*MESSAGES, "{bad"])
    moved, rename = [], commits.Folder.rename

    def some(folder, source, target):
        if "part-" in source.getName():
            moved.append(target.toString())
            if len(moved) > 2:
                raise ZeroDivisionError("division by zero")
        rename(folder, source, target)

    with ingest_runs.monkeypatch.context() as broken:
        broken.setattr(commits, "MOVERS", 1)
        broken.setattr(commits.Folder, "rename", some)
        with pytest.raises(Exception, match="division by zero"):
            ingest_runs.run()
    assert 0 < spark.read.json(ingest_runs.lake).count() < 5  # moved, but not yet in sight:
    assert ingest_runs.events() == 0 and ingest_runs.values() == []
    with ingest_runs.monkeypatch.context() as broken:  # nothing is staged again, only moved on
        broken.setattr(streaming_ingest, "accepted", lambda *a, **k: 1 / 0)
        ingest_runs.run()
    assert ingest_runs.events() == 5 and ingest_runs.values() == ["{bad"]
    assert spark.read.json(ingest_runs.lake).count() == 5
    ingest_runs.run()
    assert ingest_runs.events() == 5


def test_ingest_reads_its_source_once(inbox, ingest_runs, spark):
    inbox("1.txt", [*MESSAGES, "{bad"])
    query = ingest_runs.run()
    assert [(p.numInputRows, len(p.sources)) for p in query.recentProgress if p.numInputRows] == [(6, 1)]
    assert [tuple(x)[1:] for x in commits.read_commits(spark, ingest_runs.lake).collect()] == [(0, 6, 5, 1)]


def test_lake_and_rejects_at_the_same_batch(inbox, ingest_runs, spark):
    inbox("1.txt", [*MESSAGES[:2], "{bad"])
    ingest_runs.run()
    last = commits.done(spark, ingest_runs.lake)
    inbox("2.txt", [*MESSAGES[2:], "worse"])
    ingest_runs.run()
    assert read_lake(spark, ingest_runs.lake, last=last).count() == 2
    assert read_rejects(spark, ingest_runs.rejects, ingest_runs.lake, last).count() == 1
    assert ingest_runs.events() == 5 and len(ingest_runs.values()) == 2


def test_counts_that_do_not_add_up_are_not_committed(inbox, ingest_runs, monkeypatch):
    inbox("1.txt", [*MESSAGES, "{bad"])
    whole = streaming_ingest.accepted
    with monkeypatch.context() as broken:
        broken.setattr(streaming_ingest, "accepted", lambda *a, **k: whole(*a, **k).filter("zone <> 'Suburbs'"))
        with pytest.raises(Exception, match="6 messages read, 4 accepted and 1 rejected"):
            ingest_runs.run()
    assert ingest_runs.events() == 0 and ingest_runs.values() == []
    ingest_runs.run()
    assert ingest_runs.events() == 5


def test_records_are_not_kept_for_ever(inbox, ingest_runs, spark, monkeypatch):
    monkeypatch.setattr(commits, "KEPT_RECORDS", 2)
    for number in range(4):
        inbox(f"{number}.txt", [MESSAGES[number], "{bad"])
        ingest_runs.run()
    assert [x.number for x in commits.read_commits(spark, ingest_runs.lake).collect()] == [2, 3]
    assert ingest_runs.events() == 4
    stream = next(iter(commits.done(spark, ingest_runs.lake)))
    assert [commits.state(spark, ingest_runs.lake, stream, x) for x in (0, 3, 4)] == ["done", "done", None]


def test_zones_that_are_no_plain_folder_names(inbox, ingest_runs, spark):
    zones = ["a b", "x%y", "50%25", "é:1", "a/b", "q=1", "01"]
    inbox("1.txt", [message(zone=x) for x in zones])
    ingest_runs.run()
    assert sorted(x.zone for x in read_lake(spark, ingest_runs.lake).collect()) == sorted(zones)


def test_following_two_lakes(spark, golden, tmp_path):
    old, new, store = (str(tmp_path / name) for name in ("old", "new", "store"))
    write_lake(golden, old)
    write_lake(golden, new, "parquet")
    both = stream_lake(spark, old).union(stream_lake(spark, new, "parquet"))
    paths = Refresh("", store)
    start_following(spark, paths, events=both).awaitTermination()
    assert rows(read_table(spark, store, "critical_zones")) == {
        ("Downtown", 4),
        ("Residential-North", 2),
        ("Industrial", 0),
        ("Suburbs", 0),
    }


def test_conversion_of_a_growing_lake(spark, golden, tmp_path):
    source, root = str(tmp_path / "json"), str(tmp_path / "parquet")
    for copies in (1, 2):
        write_lake(golden, source)
        events = stream_lake(spark, source)
        start_conversion(events, root, str(tmp_path / "c"), trigger=ONCE).awaitTermination()
        typed_lake = read_lake(spark, root, "parquet")
        assert typed_lake.count() == 5 * copies
        assert rows(typed_lake) == rows(read_lake(spark, source))


def test_jobs(spark, golden, inbox, tmp_path, monkeypatch):
    inbox("1.txt", [*MESSAGES, "{bad"])
    lake, rejects, checkpoint = (str(tmp_path / n) for n in ("lake", "rejects", "checkpoint"))
    common = ["--lake", lake, "--rejects", rejects, "--checkpoint", checkpoint, "--once"]
    report = str(tmp_path / "report")
    for _ in range(2):
        ingest.main([*common, "--files", inbox.path, "--report", report])
    assert rows(read_lake(spark, lake).select(*EVENT_COLUMNS)) == rows(golden)
    assert read_rejects(spark, rejects, lake).count() == 1
    typed_lake = str(tmp_path / "typed")
    convert.main(["--source", lake, "--lake", typed_lake, "--checkpoint", f"{checkpoint}/t"])
    store = str(tmp_path / "store")
    refresh.main(["--lake", typed_lake, "--lake-format", "parquet", "--store", store])
    assert spark.read.parquet(f"{store}/traffic_by_zone").count() == 4
    loaded = {}
    monkeypatch.setenv("JDBC_PASSWORD", "secret")
    monkeypatch.setattr(
        "roadpulse.plans.refresh.write_database",
        lambda table, database, name, connections: loaded.update({name: database.password}),
    )
    publish.main(["--store", store, "--url", "jdbc:x", "--user", "u"])
    assert loaded == {name: "secret" for name in KPI_NAMES}
    inbox("2.txt", [message(event_time="2026-01-03T08:00:00", zone="Suburbs")])
    ingest.main([*common, "--files", inbox.path, "--report", report])
    counts = spark.read.parquet(report)
    assert counts.filter("batch = 0").agg({"events": "sum"}).first()[0] == 5
    assert rows(counts.filter("batch = 1").select("date", "zone", "events")) == {
        (date(2026, 1, 3), "Suburbs", 1)
    }


def test_jobs_over_a_lake_with_a_broken_line(spark, golden, tmp_path):
    lake, store = str(tmp_path / "lake"), str(tmp_path / "store")
    write_lake(golden, lake)
    folder = next((tmp_path / "lake").glob("date=*/zone=Suburbs"))
    (folder / "broken.json").write_text('{"sensor_id":\n')
    args = ["--lake", lake, "--store", store]
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ"):
        process.main(args)
    process.main([*args, "--read-mode", "DROPMALFORMED"])
    assert read_table(spark, store, "traffic_by_zone").agg({"event_count": "sum"}).first()[0] == 5
    typed_lake = str(tmp_path / "typed")
    convert.main(
        ["--source", lake, "--lake", typed_lake, "--checkpoint", str(tmp_path / "c")]
        + ["--read-mode", "DROPMALFORMED", "--files-per-batch", "2"]
    )
    assert read_lake(spark, typed_lake, "parquet").count() == 5
    followed = str(tmp_path / "followed")
    refresh.main(
        ["--lake", typed_lake, "--lake-format", "parquet", "--store", followed]
        + ["--files-per-batch", "1"]
    )
    total = read_table(spark, followed, "traffic_by_zone").agg({"event_count": "sum"})
    assert total.first()[0] == 5


def test_report_of_a_lake_that_is_not_there_yet(spark, inbox, tmp_path):
    root, path = str(tmp_path / "lake"), str(tmp_path / "report")
    make_folder(spark, root)
    often = {"processingTime": "0 seconds"}
    report = start_report(stream_lake(spark, root), path, str(tmp_path / "c1"), often)
    try:
        report.processAllAvailable()
        inbox("1.txt", MESSAGES)
        messages = message_files(spark, inbox.path)
        start_ingest(messages, root, str(tmp_path / "c2"), trigger=ONCE).awaitTermination()
        report.processAllAvailable()
    finally:
        report.stop()
    assert spark.read.parquet(path).agg({"events": "sum"}).first()[0] == 5


def test_live_job(spark, golden, inbox, tmp_path):
    inbox("1.txt", [*MESSAGES, "{bad", message(event_time="2026-01-03T08:00:00")])
    alerts, hours = str(tmp_path / "alerts"), str(tmp_path / "hours")
    live_job.main(
        ["--files", inbox.path, "--alerts", alerts, "--hours", hours]
        + ["--checkpoint", str(tmp_path / "c"), "--once"]
    )
    assert spark.read.parquet(alerts).filter("date = DATE '2026-01-02'").count() == 3
    table = live.read_hours(spark, hours).select("window_start", "zone", "events")
    assert table.count() == 6
    assert (datetime(2026, 1, 2, 18), "Downtown", 1) in rows(table)


def test_hours(spark, tmp_path):
    """Open hours appear in the table; closed ones are sent once, and late events are late."""
    session = stream_session(spark, state_partitions=2)
    session.conf.set("spark.sql.session.timeZone", "UTC")
    folder, late = str(tmp_path / "in"), {}

    def add(*events):
        frame = spark.createDataFrame(
            [("S1", "R1", "Street", zone, n, 50, 1.0, time) for zone, n, time in events], RAW_EVENT
        )
        typed(frame).coalesce(1).write.mode("append").parquet(folder)

    def hours(kind):
        stream = session.readStream.schema(typed(spark.createDataFrame([], RAW_EVENT)).schema)
        start = live.start_hourly if kind == "closed" else live.start_hourly_table
        path = f"{tmp_path}/{kind}"
        query = start(stream.parquet(folder), path, f"{path}-c", trigger=ONCE)
        query.awaitTermination()
        late[kind] = live.late_rows(query)
        table = spark.read.parquet(path) if kind == "closed" else live.read_hours(spark, path)
        return rows(table.select("window_start", "zone", "avg_vehicles", "events"))

    def at(hour):
        return datetime(2026, 1, 2, hour)

    add(("A", 2, "2026-01-02T08:00:00"), ("A", 4, "2026-01-02T08:59:59.999999"))
    assert hours("closed") == set()
    assert hours("open") == {(at(8), "A", 3.0, 2)}
    add(("B", 1, "2026-01-02T09:05:00"))
    assert hours("closed") == set()
    add(("A", 6, "2026-01-02T08:30:00"), ("B", 3, "2026-01-02T09:10:00"))
    assert hours("closed") == {(at(8), "A", 4.0, 3)}
    assert hours("open") == {(at(8), "A", 4.0, 3), (at(9), "B", 2.0, 2)}
    assert late["closed"] == 0
    add(("A", 100, "2026-01-02T08:30:00"), ("A", 7, None), ("C", None, "2026-01-02T09:00:00"))
    assert hours("closed") == {(at(8), "A", 4.0, 3)}
    assert late["closed"] == 1
    assert hours("open") == {
        (at(8), "A", 28.0, 4),
        (at(9), "B", 2.0, 2),
        (at(9), "C", None, 1),
        (None, "A", 7.0, 1),
    }
    assert late["open"] == 0


def _timed(spark, *events):
    raw = [("S1", "R1", "Street", zone, n, 50, 1.0, time) for zone, n, time in events]
    return typed(spark.createDataFrame(raw, RAW_EVENT))


def test_late_events_are_kept_apart(spark, tmp_path, monkeypatch):
    """Closed and late and open hours are all events, also after batches that broke off."""
    folder, path, steps = str(tmp_path / "in"), str(tmp_path / "hours"), []

    def run():
        stream = spark.readStream.schema(_timed(spark).schema).parquet(folder)
        live.start_hours(stream, path, str(tmp_path / "c"), trigger=ONCE).awaitTermination()

    def add(*events):
        steps.extend(events)
        _timed(spark, *events).coalesce(1).write.mode("append").parquet(folder)
        for name in ("write", "delete"):
            with monkeypatch.context() as broken:
                broken.setattr(Folder, name, lambda *a: 1 / 0)
                with pytest.raises(Exception, match="division by zero"):
                    run()
        run()
        parts = live.read_parts(spark, path)
        every = added_hours(hourly_sums(_timed(spark, *steps)))
        assert rows(added_hours(parts)) == rows(every)
        return {(r.window_start and r.window_start.hour, r.zone, r.part, r.events) for r in parts.collect()}

    assert live.read_parts(spark, path).count() == 0
    first = add(("A", 2, "2026-01-02T08:00:00"), ("A", 4, "2026-01-02T08:59:59"), ("B", 1, None))
    assert first == {(8, "A", "open", 2), (None, "B", "late", 1)}
    second = add(("A", 6, "2026-01-02T08:30:00"), ("A", 3, "2026-01-02T09:10:00"))
    assert second == {(8, "A", "closed", 3), (9, "A", "open", 1), (None, "B", "late", 1)}
    third = add(("A", 8, "2026-01-02T08:40:00"), ("B", None, "2026-01-02T09:20:00"), ("A", 1, None))
    assert third - second == {(8, "A", "late", 1), (9, "B", "open", 1), (None, "A", "late", 1)}
    fourth = add(("C", 1, "2026-01-02T11:10:00"))
    assert {x for x in fourth if x[0] == 9} == {(9, "A", "closed", 1), (9, "B", "closed", 1)}
    assert (11, "C", "open", 1) in fourth


def test_conflicts_as_events_arrive(spark, tmp_path):
    folder, path = str(tmp_path / "in"), str(tmp_path / "sensors")
    steps = []

    def add(*sensors):
        raw = [(s, road, kind, zone, 1, 50, 1.0, "2026-01-02T08:00:00") for s, road, kind, zone in sensors]
        steps.extend(raw)
        typed(spark.createDataFrame(raw, RAW_EVENT)).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(_timed(spark).schema).parquet(folder)
        live.start_sensor_check(stream, path, str(tmp_path / "c"), trigger=ONCE).awaitTermination()
        found = rows(live.read_conflicts(spark, path))
        assert found == rows(checks.sensor_conflicts(spark.createDataFrame(steps, RAW_EVENT)))
        return {x[0] for x in found}

    assert add(("S1", "R1", "Street", "A"), ("S1", "R1", "Street", "A"), ("S2", "R2", None, "B")) == set()
    assert add(("S2", "R2", None, "B"), ("S1", "R1", "Street", "A")) == set()
    assert spark.read.parquet(path).count() == 2  # nothing new, nothing added
    assert add(("S2", "R2", "Street", "B"), ("S3", "R1", "Street", "A")) == {"S2"}
    assert add(("S1", "R1", "Street", "C"), ("S1", "R9", "Street", "C"), (None, "R9", "Street", "C")) == {"S1", "S2"}


def test_unknown_fields_of_messages(inbox, ingest_runs, spark):
    more = [message(lane=2), message(lane=2.5, event_time="2026-01-03T08:00:00"), message(lane="x", tags={"a": [1]})]
    twice = message()[:-1] + ', "lane": 1, "lane": 2}'
    inbox("1.txt", [*MESSAGES, *more, message(average_speed=35.5), twice])
    ingest_runs.run()
    found = rows(drift.unknown_fields(read_extra(spark, ingest_runs.lake)))
    assert {x for x in found if x[1] is not None} == {
        (date(2026, 1, 2), "lane", "VARIANT", 2),
        (date(2026, 1, 2), "tags", "OBJECT<a: ARRAY<BIGINT>>", 1),
        (date(2026, 1, 3), "lane", "DECIMAL(2,1)", 1),
    }
    assert [x for x in found if x[1] is None] == [(date(2026, 1, 2), None, "VOID", 1)]


def test_windows_need_a_utc_session(spark, golden):
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    events = typed(session.createDataFrame(GOLDEN, RAW_EVENT))
    with pytest.raises(ValueError, match="Kolkata"):
        hourly_by_zone(events)
    hours = hourly_by_zone(typed(stream_session(spark).createDataFrame(GOLDEN, RAW_EVENT)))
    assert (datetime(2026, 1, 2, 18), "Downtown", 1) in rows(
        hours.select("window_start", "zone", "events")
    )


def test_stream_session_keeps_settings_to_itself(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    session = stream_session(spark, state_partitions=3)
    assert session.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


class _Settings:
    def __init__(self, **values):
        self.conf = self
        self.values = {name.replace("_", "."): value for name, value in values.items()}

    def get(self, name, default=None):
        return self.values.get(name, default)


def test_scratch_lies_in_the_shared_folder():
    shared = _Settings(spark_checkpoint_dir="hdfs://shared/dir/", spark_master="yarn")
    assert scratch(shared, "lake").startswith("hdfs://shared/dir/roadpulse/lake-")
    assert scratch(shared, "lake") != scratch(shared, "lake")
    with pytest.raises(RuntimeError):
        scratch(_Settings(spark_master="yarn"), "lake")
    assert scratch(_Settings(spark_master="local[2]"), "lake")
