"""Random events against a plain computation row by row."""

from __future__ import annotations

import json
from collections import Counter, defaultdict
from datetime import datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from roadpulse.functions.codec import REASONS
from roadpulse.operators import ingest, kpis, summary
from roadpulse.schema import EVENT, EVENT_COLUMNS

FEW = settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)

events = st.lists(
    st.tuples(
        st.sampled_from(["S1", "S2"]),
        st.sampled_from(["R1", "R2"]),
        st.sampled_from(["Highway", "Street", None]),
        st.sampled_from(["A", "B", None]),
        st.one_of(st.none(), st.integers(0, 100)),
        st.one_of(st.none(), st.integers(38, 42)),
        st.one_of(st.none(), st.sampled_from([69.99, 70.0, 70.01])),
        st.one_of(st.none(), st.datetimes(datetime(2026, 1, 1), datetime(2026, 1, 3))),
    ),
    max_size=40,
)


def mean(values):
    known = [v for v in values if v is not None]
    return sum(known) / len(known) if known else None


def grouped(rows, key):
    groups = defaultdict(list)
    for row in rows:
        groups[key(row)].append(row)
    return groups


def congested(row):
    return (row[5] is not None and row[5] < 40) or (row[6] is not None and row[6] > 70)


@FEW
@given(events)
def test_indicators(spark, rows):
    table = spark.createDataFrame(rows, EVENT)
    by_zone = grouped(rows, lambda r: r[3])
    by_road = grouped(rows, lambda r: r[2])
    by_hour = grouped(rows, lambda r: r[7].hour if r[7] else None)
    expected = {
        "traffic_by_zone": {(z, mean(r[4] for r in g), len(g)) for z, g in by_zone.items()},
        "speed_by_road": {(t, mean(r[5] for r in g)) for t, g in by_road.items()},
        "hourly_stats": {
            (h, mean(r[4] for r in g), mean(r[5] for r in g)) for h, g in by_hour.items()
        },
        "critical_zones": {(z, sum(map(congested, g))) for z, g in by_zone.items()},
    }
    from_summary = summary.indicators(summary.summarize(table))
    for name, result in expected.items():
        assert set(map(tuple, from_summary[name].collect())) == result
        assert set(map(tuple, getattr(kpis, name)(table).collect())) == result
    alerts = Counter((r[3], r[2], r[5], r[6], r[7]) for r in rows if congested(r))
    assert Counter(map(tuple, kpis.congestion_alerts(table).collect())) == alerts


def is_json_object(text):
    try:
        return isinstance(json.loads(text), dict)
    except ValueError:
        return False


messages = st.lists(
    st.one_of(
        st.text(alphabet='{}[]",:0a \\', max_size=12),
        st.builds(json.dumps, st.recursive(
            st.one_of(st.none(), st.booleans(), st.integers(-5, 5), st.text(max_size=5)),
            lambda inner: st.one_of(
                st.lists(inner, max_size=3),
                st.dictionaries(st.sampled_from(EVENT_COLUMNS), inner, max_size=4),
            ),
            max_leaves=6,
        )),
    ),
    min_size=1,
    max_size=40,
)


@FEW
@given(messages)
def test_decoding_never_fails_and_loses_nothing(spark, values):
    table = spark.createDataFrame(list(enumerate(values)), "n INT, value STRING")
    decoded = ingest.decode(table)
    found = decoded.select("n", "value", "reason").collect()
    assert sorted(r.n for r in found) == list(range(len(values)))
    for row in found:
        assert row.reason is None or row.reason in REASONS
        if row.reason is None or row.reason in ("bad_event_time", "missing_zone"):
            assert is_json_object(row.value)
    good, bad = ingest.accepted(decoded, "n").count(), ingest.rejected(decoded, "n").count()
    assert good + bad == len(values)
