"""Writing the stored tables into a version in the making."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roadpulse.operators.summary import merge
from roadpulse.schema import KPI_SCHEMAS, SUMMARY
from roadpulse.sources.store import ALERTS, SUMMARY_NAME
from roadpulse.sources.versions import Draft, Parts, Version, find, read_dated

#: Small parts of a date from which on they are joined, and bytes from which on a part is none.
MOST_PARTS, SMALL = 8, 128 << 20


def write_summary(draft: Draft, summary: DataFrame) -> Parts:
    # Some hundred rows a date: one task writes a date's single file.
    return draft.write_dated(summary.repartition("date"), SUMMARY_NAME)


def write_alerts(draft: Draft, alerts: DataFrame) -> Parts:
    """Alerts (with ``date``) are the one table that grows with the input. They are written where they
    were computed: no shuffle, no sort, and no date is gathered in one task."""
    return draft.write_dated(alerts, ALERTS)


def compact(spark: SparkSession, store: str, most_parts: int = MOST_PARTS, small: int = SMALL) -> Version | None:
    """Joins the small parts of dates that have more than ``most_parts`` of them, as a new version.

    Parts of ``small`` bytes or more stay as they are, so what is written again is bounded, and the
    parts of a date by its size and ``most_parts``, not by the batches that came. Nothing changes in
    what is read. None if there was nothing to join.
    """
    version = find(spark, store)
    if version is None:
        return None
    draft, joined = Draft(spark, store, version), False
    for name, schema in ((SUMMARY_NAME, SUMMARY), (ALERTS, KPI_SCHEMAS[ALERTS])):
        days = {day: [x for x in parts if x[1] < small] for day, parts in version.dated.get(name, {}).items()}
        days = {day: parts for day, parts in days.items() if len(parts) > most_parts}
        if not days:
            continue
        rows = read_dated(spark, store, days, name, schema)
        # By date, and large dates cut by size where the planner adapts.
        rows = merge(rows).repartition("date") if name == SUMMARY_NAME else rows.hint("rebalance", "date")
        written = draft.write_dated(rows, name)
        left = {day: [x for x in version.dated[name][day] if x not in parts] for day, parts in days.items()}
        draft.replace_dates(name, left, set(days))
        draft.add(name, written)
        joined = True
    return draft.commit() if joined else None
