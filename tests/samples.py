"""Five sample events and helpers to vary them."""

from __future__ import annotations

import contextlib
import io
import json

from roadpulse.schema import EVENT_COLUMNS

GOLDEN = [
    ("S001", "R003", "Highway", "Downtown", 62, 30, 74.5, "2026-01-02T08:31:00.000000"),
    ("S002", "R011", "Avenue", "Industrial", 31, 48, 40.0, "2026-01-02T08:37:00.000000"),
    ("S003", "R017", "Street", "Residential-North", 15, 22, 91.5, "2026-01-02T08:44:00.000000"),
    ("S004", "R006", "Highway", "Suburbs", 81, 70, 33.0, "2026-01-02T14:25:00.000000"),
    ("S005", "R014", "Avenue", "Downtown", 55, 18, 86.0, "2026-01-02T18:10:00.000000"),
]


def as_dict(row) -> dict:
    return dict(zip(EVENT_COLUMNS, row))


def message(without: str | None = None, **changes) -> str:
    event = {**as_dict(GOLDEN[0]), **changes}
    if without:
        del event[without]
    return json.dumps(event)


def rows(table) -> set:
    return {tuple(row) for row in table.collect()}


def plan(table) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        table.explain("formatted")
    return text.getvalue()
