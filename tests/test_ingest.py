"""Decoding, rejecting, encoding and routing of messages."""

from __future__ import annotations

import json
from datetime import date, datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from samples import GOLDEN, as_dict, message, plan, rows

from roadpulse.operators import ingest
from roadpulse.schema import EVENT_COLUMNS, RAW_EVENT

GOOD = message()


def reasons(spark, *values):
    messages = spark.createDataFrame(
        [(v if isinstance(v, bytes) or v is None else v.encode(),) for v in values],
        "value BINARY",
    )
    return [r.reason for r in ingest.decode(messages).collect()]


@pytest.mark.parametrize(
    "value, reason",
    [
        (GOOD, None),
        (f"  {GOOD}\n", None),
        (message(extra={"a": [1]}), None),
        (message(without="vehicle_count"), None),
        (message(vehicle_count=None), None),
        (message(event_time="2026-01-02T14:30:00"), None),
        (message(event_time="2026-01-02T14:30:00+05:00"), None),
        (message(event_time="2026-01-02"), None),
        ("", "blank"),
        ("\t", "blank"),
        ("\n", "blank"),
        ("  \t\r\n", "blank"),
        (f"\t{GOOD}", None),
        (f"\n{GOOD}", None),
        (f"\r\n {GOOD}\t", None),
        ("\u00a0" + GOOD, "not_object"),
        (None, "blank"),
        ("{bad", "malformed"),
        (GOOD[:-1], "malformed"),
        (GOOD + "}", "malformed"),
        (GOOD + " tail", "malformed"),
        (GOOD + ',"y":1', "malformed"),
        (GOOD + ',"complete":true', "malformed"),
        (GOOD + ',"complete":true}', "malformed"),
        (GOOD + ',"event":' + message(zone="Other"), "malformed"),
        (GOOD + ",1]", "malformed"),
        (GOOD + "],[" + GOOD, "malformed"),
        (GOOD + ',"k"', "malformed"),
        (GOOD + ",", "malformed"),
        (GOOD + ",null", "malformed"),
        (message(complete=False, event={"zone": "x"}, broken="x"), None),
        (message(occupancy_rate=float("nan")), "malformed"),
        (GOOD + GOOD, "malformed"),
        (f"{GOOD},{GOOD}", "malformed"),
        (GOOD.replace('"S001"', "'S001'"), "malformed"),
        (message(vehicle_count="x"), "malformed"),
        (message(average_speed=35.0), None),
        (message(average_speed=35.5), None),
        (message(vehicle_count=1e300), "malformed"),
        (message(vehicle_count="NaN"), "malformed"),
        (GOOD.encode().replace(b"S001", b"\xff\xfe"), "malformed"),
        ("5", "not_object"),
        ("[1]", "not_object"),
        (f"[{GOOD}]", "not_object"),
        ("null", "not_object"),
        ("hello", "not_object"),
        (message(without="event_time"), "bad_event_time"),
        (message(event_time="zzz"), "bad_event_time"),
        (message(event_time="14:30"), "bad_event_time"),
        (message(event_time="2026"), "bad_event_time"),
        (message(event_time=5), "bad_event_time"),
        (message(event_time="2026-01-02T25:00:00"), "bad_event_time"),
        (message(without="zone"), "missing_zone"),
        (message(zone=None), "missing_zone"),
        (message(zone=""), "missing_zone"),
    ],
)
def test_reasons(spark, value, reason):
    assert reasons(spark, value) == [reason]


def test_text_values_and_split(spark):
    messages = spark.createDataFrame([(1, GOOD), (2, "{bad")], "n INT, value STRING")
    decoded = ingest.decode(messages)
    good = ingest.accepted(decoded, "n")
    assert good.columns == ["n", *EVENT_COLUMNS]
    assert rows(good) == {(1, *GOLDEN[0])}
    assert rows(ingest.rejected(decoded, "n")) == {(2, "{bad", "malformed")}


def test_nothing_of_a_good_message_is_lost(spark):
    more, rounded, same = message(lane=2), message(average_speed=35.5), message(average_speed=35.0)
    messages = spark.createDataFrame([(x,) for x in (GOOD, more, rounded, same)], "value STRING")
    events = ingest.accepted(ingest.decode(messages), extra="value").collect()
    assert [x.message for x in events] == [None, more, rounded, None]
    assert [x.average_speed for x in events] == [30, 30, 36, 35]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.sampled_from('{}[],:"01 ntrue'), max_size=14), min_size=40, max_size=40))
def test_what_json_refuses_is_refused(spark, tails):
    """Whatever follows a good message: it is good only if a JSON reader takes the whole for an object."""

    def whole_object(text):
        try:
            return isinstance(json.loads(text), dict)
        except ValueError:
            return False

    texts = [GOOD + tail for tail in tails] + [GOOD[:-1] + tail for tail in tails]
    found = reasons(spark, *texts)
    assert [x for x, reason in zip(texts, found) if reason is None and not whole_object(x)] == []


def test_a_filter_does_not_parse_twice(spark):
    messages = spark.createDataFrame([(GOOD,)], "value STRING")
    for table in (
        ingest.accepted(ingest.decode(messages)),
        ingest.rejected(ingest.decode(messages)),
    ):
        assert plan(table).count("from_json(") == 1


def test_encode_then_decode(spark, golden):
    messages = ingest.encode(golden)
    assert messages.dtypes == [("key", "binary"), ("value", "binary")]
    first = messages.filter("key = CAST('S001' AS BINARY)").first()
    assert bytes(first.key) == b"S001"
    assert json.loads(bytes(first.value)) == as_dict(GOLDEN[0])
    back = ingest.typed(ingest.accepted(ingest.decode(messages)))
    assert rows(back) == rows(golden)


def test_times_keep_six_digits_in_every_zone(spark):
    other = spark.newSession()
    # 02:30 does not exist on this day in New York.
    other.conf.set("spark.sql.session.timeZone", "America/New_York")
    times = [f"2026-03-08T02:30:00.{digits}" for digits in ("000001", "100000", "000000")]
    events = ingest.typed(
        other.createDataFrame([(*GOLDEN[0][:-1], t) for t in times], RAW_EVENT)
    )
    values = ingest.encode(events).selectExpr("CAST(value AS STRING) AS value").collect()
    assert sorted(json.loads(v.value)["event_time"] for v in values) == sorted(times)


def test_route_by_event_time(spark):
    times = ["2026-01-01T23:59:59.999999", "2026-01-02T00:00:00", "2026-01-02T23:30:00-05:00"]
    events = spark.createDataFrame([(*GOLDEN[0][:-1], t) for t in times], RAW_EVENT)
    dates = [r.date for r in ingest.route(events).orderBy("event_time").collect()]
    assert dates == [date(2026, 1, 1), date(2026, 1, 2), date(2026, 1, 2)]
    wall = [r.event_time for r in ingest.typed(events).orderBy("event_time").collect()]
    assert wall[2] == datetime(2026, 1, 2, 23, 30)


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_spread_cuts_a_hot_zone_and_loses_nothing(spark, adaptive):
    session = spark.newSession()
    session.conf.set("spark.sql.adaptive.enabled", adaptive)
    hot = session.range(0, 1000, 1, 8).selectExpr(
        "DATE '2026-01-02' AS date", "'A' AS zone", "id"
    )

    def pieces(tasks_per_file):
        table = ingest.spread(hot, tasks_per_file, partitions=32)
        assert table.columns == hot.columns
        found = table.selectExpr("spark_partition_id() AS p", "id").collect()
        assert sorted(r.id for r in found) == list(range(1000))
        return len({r.p for r in found})

    assert pieces(8) == 1
    # The adaptive planner cuts by size, and this is small.
    assert pieces(1) == 1 if adaptive == "true" else pieces(1) > 3


def test_partition_counts_read_no_data_column(spark, golden, tmp_path):
    from roadpulse.sinks.lake import write_lake
    from roadpulse.sources.lake import read_lake

    write_lake(golden, str(tmp_path / "lake"), "parquet")
    counts = ingest.partition_counts(read_lake(spark, str(tmp_path / "lake"), "parquet"))
    assert ("Downtown", 2) in {(r.zone, r.events) for r in counts.collect()}
    assert "ReadSchema: struct<>" in plan(counts)
