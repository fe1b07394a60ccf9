"""Options handed to connectors that are not installed here (topic and database)."""

from __future__ import annotations

import re
from contextlib import contextmanager

import pytest
from pyspark.errors import AnalysisException

from roadpulse.plans import refresh
from roadpulse.schema import KPI_NAMES
from roadpulse.sinks import database as database_sink
from roadpulse.sinks.database import write_database
from roadpulse.sinks.topic import start_topic, write_topic
from roadpulse.sources.database import Database, database_count, read_database
from roadpulse.sources.messages import topic

DATABASE = Database("jdbc:postgresql://db/traffic", "someone", "secret")


class Recorder:
    """Stands in for a session or a table and notes every call made on it."""

    def __init__(self, answer=None):
        self.calls, self.answer = [], answer

    @property
    def read(self):
        return self

    readStream = write = writeStream = read

    def __getattr__(self, name):
        if name.startswith("__"):
            raise AttributeError(name)

        def call(*args, **kwargs):
            self.calls.append((name, args, kwargs))
            return self.answer if name == "first" else self

        return call

    @property
    def settings(self):
        found = {}
        for name, args, kwargs in self.calls:
            if name == "option":
                found[args[0]] = args[1]
            elif name == "options":
                found.update(kwargs)
            elif name in ("format", "mode"):
                found[name] = args[0]
        return found


def test_topic_options():
    session = Recorder()
    topic(session, "broker:1", batch_rows=500, min_partitions=64, options={"x": "y"})
    assert session.settings == {
        "format": "kafka",
        "kafka.bootstrap.servers": "broker:1",
        "subscribe": "traffic-events",
        "groupIdPrefix": "hdfs-ingest-group",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": 500,
        "minPartitions": 64,
        "x": "y",
    }


def test_topic_needs_its_connector(spark, golden):
    with pytest.raises(AnalysisException, match="kafka"):
        topic(spark, "broker:1")
    with pytest.raises(AnalysisException, match="kafka"):
        write_topic(golden, "broker:1")


def test_topic_sinks(monkeypatch):
    for module in ("roadpulse.sinks.topic.encode",):
        monkeypatch.setattr(module, lambda events: events)
    table = Recorder()
    write_topic(table, "broker:1")
    assert table.settings == {
        "format": "kafka",
        "kafka.bootstrap.servers": "broker:1",
        "topic": "traffic-events",
    }
    stream = Recorder()
    start_topic(stream, "broker:1", "/c", "other")
    assert stream.settings["checkpointLocation"] == "/c"
    assert stream.settings["topic"] == "other"


def test_database_sink():
    table = Recorder()
    write_database(table, DATABASE, "congestion_alerts", connections=8)
    assert table.settings == {
        "format": "jdbc",
        "mode": "overwrite",
        "url": "jdbc:postgresql://db/traffic",
        "user": "someone",
        "password": "secret",
        "driver": "org.postgresql.Driver",
        "dbtable": "congestion_alerts",
        "truncate": "true",
        "numPartitions": 8,
        "batchsize": 10_000,
    }
    assert "secret" not in repr(DATABASE)


def test_database_source():
    session = Recorder(answer=[7])
    read_database(session, DATABASE, "critical_zones")
    assert session.settings["dbtable"] == "critical_zones"
    session = Recorder(answer=[7])
    assert database_count(session, DATABASE, "critical_zones") == 7
    assert session.settings["query"] == "SELECT COUNT(*) AS row_total FROM critical_zones"


def test_alerts_are_appended_batch_by_batch(monkeypatch, spark, golden, tmp_path):
    from roadpulse.operators.ingest import route
    from roadpulse.plans import follow

    loads = []
    monkeypatch.setattr(refresh, "write_database", lambda t, d, name, c: loads.append((name, "all", t.count())))
    monkeypatch.setattr(follow, "load_once", lambda t, d, name, *rest: loads.append((name, t.count(), *rest)))
    paths = refresh.Refresh("", str(tmp_path / "store"), database=DATABASE, alert_connections=3)
    batches = [golden, golden.limit(0).union(golden.filter("sensor_id = 'S001'")), golden.filter("sensor_id = 'S004'")]
    for number, batch in enumerate(batches):
        follow.publish_batch(spark, paths, follow.add_batch(spark, route(batch), paths.store, number, "q"))
    alerts = [x[1:] for x in loads if x[0] == "congestion_alerts"]
    assert alerts == [(3, "q/0", 3, True), (1, "q/1", 3, False), (0, "q/2", 3, False)]
    assert {x[0] for x in loads} == set(KPI_NAMES)


class Tables:
    """Stands in for a database: tables of rows, and transactions over the statements of a load."""

    def __init__(self, monkeypatch):
        self.held, self.fails, self.repeats = {}, set(), 1
        monkeypatch.setattr(database_sink, "append_database", lambda t, d, name, *rest: self.write(t, name, False))
        monkeypatch.setattr(database_sink, "write_database", lambda t, d, name, *rest: self.write(t, name, True))
        monkeypatch.setattr(database_sink, "transaction", self.transaction)

    def write(self, table, name, replace):
        rows = [x.asDict() for x in table.collect()]
        self.held[name] = ([] if replace else self.held.get(name, [])) + rows * self.repeats

    @contextmanager
    def transaction(self, spark, database):
        before = {name: list(rows) for name, rows in self.held.items()}
        try:
            yield self
        except BaseException:
            self.held = before
            raise

    def number(self, sql, *values):
        name = re.fullmatch(r"SELECT COUNT\(\*\) FROM (\w+) WHERE load_key = \?", sql)[1]
        return sum(x["load_key"] == values[0] for x in self.held[name])

    def run(self, sql, *values):
        kind = sql.split(" ")[0]
        if sql.split(" ")[0] in self.fails:
            raise ConnectionError(kind)
        if found := re.fullmatch(r"DELETE FROM (\w+)", sql):
            self.held[found[1]] = []
        elif found := re.fullmatch(r"DROP TABLE (\w+)", sql):
            del self.held[found[1]]
        elif found := re.fullmatch(r"INSERT INTO (\w+) \((\w+)\) VALUES \(\?\)", sql):
            if "INSERT KEY" in self.fails:
                raise ConnectionError(sql)
            self.held[found[1]].append({found[2]: values[0]})
        else:
            found = re.fullmatch(
                r"INSERT INTO (\w+) \((.+)\) SELECT \2 FROM \(SELECT DISTINCT load_row, \2 FROM (\w+)\) moved", sql
            )
            columns = found[2].split(", ")
            distinct = {tuple(x[c] for c in ["load_row", *columns]) for x in self.held[found[3]]}
            self.held[found[1]] += [dict(zip(columns, x[1:])) for x in distinct]


def test_a_batch_loaded_twice_counts_once(monkeypatch, spark, golden):
    tables = Tables(monkeypatch)
    alerts = golden.select("zone", "average_speed")
    load = lambda table, key, replace=False: database_sink.load_once(table, DATABASE, "alerts", key, 2, replace)
    assert load(alerts, "q/0", replace=True) and len(tables.held["alerts"]) == 5
    tables.repeats = 2  # every task is repeated after it had written its rows
    same = alerts.union(alerts)  # equal rows are rows all the same
    assert load(same, "q/1") and len(tables.held["alerts"]) == 15
    tables.repeats = 1
    for _ in range(2):
        assert not load(same, "q/1") and not load(alerts, "q/0", replace=True)
    assert len(tables.held["alerts"]) == 15
    assert sorted(tables.held) == ["alerts", "loads_done"]


@pytest.mark.parametrize("where", ["INSERT", "INSERT KEY", "DELETE"])
def test_a_load_that_breaks_off_leaves_nothing(monkeypatch, spark, golden, where):
    tables = Tables(monkeypatch)
    alerts = golden.select("zone", "average_speed")
    assert database_sink.load_once(alerts, DATABASE, "alerts", "q/0")
    tables.fails = {where}
    with pytest.raises(ConnectionError):
        database_sink.load_once(alerts.limit(2), DATABASE, "alerts", "q/1", replace=True)
    assert len(tables.held["alerts"]) == 5 and tables.held["loads_done"] == [{"load_key": "q/0"}]
    tables.fails = set()
    assert database_sink.load_once(alerts.limit(2), DATABASE, "alerts", "q/1", replace=True)
    assert len(tables.held["alerts"]) == 2


def test_append_options():
    from roadpulse.sinks.database import append_database

    table = Recorder()
    append_database(table, DATABASE, "congestion_alerts", connections=8)
    assert table.settings["mode"] == "append" and table.settings["numPartitions"] == 8


def test_publish_and_verify(monkeypatch, spark, golden, tmp_path):
    store = str(tmp_path / "store")
    refresh.store_kpis(spark, golden, store)
    tables = {}

    def load(table, database, name, connections):
        tables[name] = (table.count(), connections)

    monkeypatch.setattr(refresh, "write_database", load)
    monkeypatch.setattr(refresh, "database_count", lambda s, d, name: tables[name][0])
    refresh.publish(spark, store, DATABASE, alert_connections=4)
    assert list(tables) == KPI_NAMES
    assert {n: c for n, (_, c) in tables.items()} == {
        n: 4 if n == "congestion_alerts" else 1 for n in KPI_NAMES
    }
    refresh.verify(spark, store, DATABASE)
    tables["congestion_alerts"] = (4, 4)
    with pytest.raises(refresh.CountMismatch, match="congestion_alerts"):
        refresh.verify(spark, store, DATABASE)
    small = [name for name in KPI_NAMES if name != "congestion_alerts"]
    refresh.verify(spark, store, DATABASE, small)
    tables.clear()
    refresh.publish(spark, store, DATABASE, small)
    assert list(tables) == small
