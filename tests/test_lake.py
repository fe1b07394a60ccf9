"""The event lake: round trips, pruning, odd zones, missing and broken files."""

from __future__ import annotations

import json
import os
from collections import Counter
from datetime import datetime

import pytest
from samples import GOLDEN, as_dict, plan, rows

from roadpulse.operators import kpis, windows
from roadpulse.operators.ingest import typed
from roadpulse.schema import EVENT_COLUMNS, RAW_EVENT
from roadpulse.sinks.lake import write_lake
from roadpulse.sources.lake import (
    LakeMissing,
    documents_read_whole,
    read_document_ranges,
    read_documents,
    read_files,
    read_lake,
)

FORMATS = ["json", "parquet"]


@pytest.mark.parametrize("fmt", FORMATS)
def test_round_trip(spark, golden, tmp_path, fmt):
    root = str(tmp_path / "lake")
    write_lake(golden, root, fmt)
    lake = read_lake(spark, root, fmt)
    assert lake.columns == [*EVENT_COLUMNS, "date"]
    assert rows(lake.select(*EVENT_COLUMNS)) == rows(golden)
    assert os.path.isdir(f"{root}/date=2026-01-02/zone=Residential-North")
    write_lake(golden, root, fmt)
    assert read_lake(spark, root, fmt).count() == 10


def test_json_keeps_the_text_of_the_time(spark, tmp_path):
    root = str(tmp_path / "lake")
    write_lake(spark.createDataFrame(GOLDEN, RAW_EVENT), root)
    text = "".join(
        open(os.path.join(folder, name)).read()
        for folder, _, names in os.walk(root)
        for name in names
        if name.startswith("part-")
    )
    lines = [json.loads(line) for line in text.splitlines()]
    assert {line["event_time"] for line in lines} == {row[-1] for row in GOLDEN}
    assert all("zone" not in line and "date" not in line for line in lines)


@pytest.mark.parametrize("fmt", FORMATS)
def test_filters_on_partitions_skip_directories(spark, golden, tmp_path, fmt):
    root = str(tmp_path / "lake")
    write_lake(golden, root, fmt)
    lake = read_lake(spark, root, fmt)
    one = lake.filter("date = DATE '2026-01-02' AND zone = 'Downtown'")
    assert one.count() == 2
    text = plan(one)
    filters = text.split("PartitionFilters")[1].split("\n")[0]
    assert "date" in filters and "zone" in filters
    hour = windows.last_hour(lake, datetime(2026, 1, 2, 15))
    assert [r.sensor_id for r in hour.collect()] == ["S004"]
    assert "2026-01-02" in plan(hour).split("PartitionFilters")[1].split("\n")[0]


def test_window_bounds_are_half_open(spark, golden):
    assert windows.last_hour(golden, datetime(2026, 1, 2, 8, 40)).count() == 2
    assert windows.last_hour(golden, datetime(2026, 1, 2, 9, 30)).count() == 3
    lake = golden.selectExpr("*", "DATE '2026-01-02' AS date")
    assert windows.between(lake, datetime(2026, 1, 2), datetime(2026, 1, 3)).count() == 5
    assert windows.last_hour(lake, datetime(2026, 1, 2, 0)).count() == 0
    with pytest.raises(ValueError):
        from datetime import timezone

        windows.last_hour(golden, datetime(2026, 1, 2, tzinfo=timezone.utc))


@pytest.mark.parametrize("zone", ["01", "a/b", "x=y", "Zürich", " "])
def test_odd_zones(spark, tmp_path, zone):
    root = str(tmp_path / "lake")
    event = spark.createDataFrame([(*GOLDEN[0][:3], zone, *GOLDEN[0][4:])], RAW_EVENT)
    write_lake(event, root)
    assert read_lake(spark, root).first().zone == zone


def test_lake_of_another_writer(spark, tmp_path):
    """The zone stands in the path and in the body; the path wins."""
    folder = tmp_path / "lake" / "date=2026-01-02" / "zone=Downtown"
    folder.mkdir(parents=True)
    lines = [json.dumps(as_dict(GOLDEN[0])), json.dumps({**as_dict(GOLDEN[1]), "zone": "Other"})]
    (folder / "events_1767361749298.json").write_text("\n".join(lines) + "\n")
    lake = read_lake(spark, str(tmp_path / "lake"))
    assert {(r.sensor_id, r.zone) for r in lake.collect()} == {
        ("S001", "Downtown"),
        ("S002", "Downtown"),
    }


def test_missing_and_empty_lake(spark, tmp_path):
    with pytest.raises(LakeMissing):
        read_lake(spark, str(tmp_path / "nothing"))
    (tmp_path / "empty").mkdir()
    assert kpis.traffic_by_zone(read_lake(spark, str(tmp_path / "empty"))).count() == 0
    with pytest.raises(ValueError):
        read_lake(spark, str(tmp_path / "empty"), "csv")


def test_broken_lines_stop_the_job(spark, tmp_path):
    folder = tmp_path / "lake" / "date=2026-01-02" / "zone=A"
    folder.mkdir(parents=True)
    (folder / "x.json").write_text('{"sensor_id": "S001", "vehicle_count": "many"}\n')
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        read_lake(spark, str(tmp_path / "lake")).collect()
    assert read_lake(spark, str(tmp_path / "lake"), mode="PERMISSIVE").first().vehicle_count is None


def test_files_without_directory_meaning(spark, tmp_path):
    """A zone without a name makes a directory that cannot be read as a partition."""
    for zone in ("", "A b"):
        folder = tmp_path / "lake" / "date=2026-01-02" / f"zone={zone}"
        folder.mkdir(parents=True)
        event = {**as_dict(GOLDEN[0]), "zone": zone}
        (folder / "events_1.json").write_text(json.dumps(event) + "\n")
    files = read_files(spark, str(tmp_path / "lake" / "*" / "*" / "*.json"))
    assert files.columns == EVENT_COLUMNS
    assert rows(kpis.traffic_by_zone(files)) == {("", 62.0, 1), ("A b", 62.0, 1)}


def test_documents(spark, tmp_path, golden):
    for number, part in enumerate((GOLDEN[:3], GOLDEN[3:])):
        text = json.dumps([as_dict(row) for row in part], indent=2)
        (tmp_path / f"{number}.json").write_text(text)
    assert rows(read_documents(spark, str(tmp_path))) == rows(golden)


def test_a_large_document_is_read_by_many_tasks(spark, tmp_path, golden):
    (tmp_path / "a b.json").write_text(json.dumps([as_dict(x) for x in GOLDEN] * 50, indent=2))
    (tmp_path / "lines.json").write_text("[" + "\n,".join(json.dumps(as_dict(x)) for x in GOLDEN) + "\n]\n")
    (tmp_path / "none.json").write_text("[ ]\n")
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    session.conf.set("spark.sql.files.openCostInBytes", "0")
    assert documents_read_whole(session, str(tmp_path)) == []
    found = read_document_ranges(session, str(tmp_path))
    assert found.rdd.getNumPartitions() > 10 >= read_documents(session, str(tmp_path)).rdd.getNumPartitions()
    assert sorted(found.collect()) == sorted(golden.collect() * 51)
    assert sorted(found.collect()) == sorted(read_documents(session, str(tmp_path)).collect())


def test_documents_that_cannot_be_cut_are_read_whole(spark, tmp_path):
    one, two = as_dict(GOLDEN[0]), as_dict(GOLDEN[1])
    texts = {
        "brace": json.dumps([{**one, "sensor_id": "a},{\"b"}, two]),
        "end": json.dumps([{**one, "sensor_id": "}]"}, two]),
        "nested": json.dumps([{**one, "place": {"x": 1}}, two]),
        "object": json.dumps(one, indent=2),
        "quote": json.dumps([{**one, "sensor_id": "\\\""}, two]),
    }
    for name, text in texts.items():
        (tmp_path / f"{name} 1.json").write_text(text)
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", "100")
    session.conf.set("spark.sql.files.openCostInBytes", "0")
    whole = {x.rsplit("/", 1)[1].split("%20")[0].split(" ")[0] for x in documents_read_whole(session, str(tmp_path))}
    assert whole == {"brace", "end", "nested", "object"}
    found, expected = (read(session, str(tmp_path)).collect() for read in (read_document_ranges, read_documents))
    assert Counter(found) == Counter(expected) and len(found) == 9


@pytest.mark.parametrize("broken", ["[%s,%s", "%s,%s]", "[%s,[%s]", "[%s %s]", "[%s,%s,]"])
def test_broken_documents_are_taken_as_a_whole_read_takes_them(spark, tmp_path, broken):
    (tmp_path / "1.json").write_text(broken % (json.dumps(as_dict(GOLDEN[0])), json.dumps(as_dict(GOLDEN[1]))))
    assert len(documents_read_whole(spark, str(tmp_path))) == 1
    outcomes = []
    for read in (read_document_ranges, read_documents):
        try:
            outcomes.append(Counter(read(spark, str(tmp_path)).collect()))
        except Exception as error:  # noqa: BLE001 - the same failure is what is compared
            outcomes.append(type(error))
    assert outcomes[0] == outcomes[1]


def test_a_wrong_type_in_a_document_stops(spark, tmp_path):
    (tmp_path / "1.json").write_text(json.dumps([{**as_dict(GOLDEN[0]), "vehicle_count": "many"}]))
    with pytest.raises(Exception, match="MALFORMED"):
        read_document_ranges(spark, str(tmp_path)).collect()
    assert read_document_ranges(spark, str(tmp_path), "PERMISSIVE").first().vehicle_count is None


def test_rebalance_keeps_files_few(spark, tmp_path):
    root = str(tmp_path / "lake")
    many = spark.range(0, 4000, 1, 16).selectExpr(
        "'S001' AS sensor_id", "'R001' AS road_id", "'Street' AS road_type",
        "concat('Z', id % 3) AS zone", "id AS vehicle_count", "id AS average_speed",
        "1.0D AS occupancy_rate", "'2026-01-02T03:04:05' AS event_time",
    )
    write_lake(many, root)
    files = [n for _, _, names in os.walk(root) for n in names if n.startswith("part-")]
    assert len(files) == 3
    assert typed(many).count() == read_lake(spark, root).count()


def test_a_lake_with_fractions_and_unknown_fields_is_read(spark, tmp_path):
    folder = tmp_path / "date=2026-01-02" / "zone=A"
    folder.mkdir(parents=True)
    events = [{**as_dict(GOLDEN[0]), "average_speed": x, "lane": 2} for x in (35, 35.0, 35.5, 1e2)]
    (folder / "x.json").write_text("\n".join(map(json.dumps, events)) + "\n")
    assert [x.average_speed for x in read_lake(spark, str(tmp_path)).collect()] == [35, 35, 36, 100]


def test_the_raw_lake_keeps_what_an_event_does_not_hold(spark, tmp_path):
    from samples import message

    from roadpulse.sources.lake import read_extra
    from roadpulse.sources.messages import message_files
    from roadpulse.streaming.ingest import ONCE, start_ingest

    more, same = message(lane=2), message()
    (tmp_path / "inbox").mkdir()
    (tmp_path / "inbox" / "1.txt").write_text(f"{more}\n{same}\n")
    for fmt in ("json", "parquet"):
        root = str(tmp_path / fmt)
        messages = message_files(spark, str(tmp_path / "inbox"))
        start_ingest(messages, root, str(tmp_path / f"c-{fmt}"), fmt, trigger=ONCE).awaitTermination()
        assert [x.message for x in read_extra(spark, root, fmt).collect()] == [more]
        assert read_lake(spark, root, fmt).count() == 2


def test_a_reading_that_no_long_holds_is_unknown(spark, golden, tmp_path):
    root = str(tmp_path / "lake")
    write_lake(golden, root)
    folder = next((tmp_path / "lake").glob("date=*/zone=Suburbs"))
    odd = {**as_dict(GOLDEN[3]), "average_speed": 1e30, "vehicle_count": 39.5}
    (folder / "odd.json").write_text(json.dumps({k: v for k, v in odd.items() if k != "zone"}) + "\n")
    for mode in ("FAILFAST", "DROPMALFORMED"):
        found = read_lake(spark, root, mode=mode).filter("zone = 'Suburbs'")
        assert {(r.average_speed, r.vehicle_count) for r in found.collect()} == {(70, 81), (None, 40)}
    assert kpis.critical_zones(read_lake(spark, root)).count() == 4
