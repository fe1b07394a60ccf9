"""From the lake to checked serving tables, in order, each stage once the last succeeded."""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.operators import kpis, panels, summary
from roadpulse.operators.checks import require_rows, row_counts
from roadpulse.operators.ingest import route
from roadpulse.schema import ALERT_COLUMNS, KPI_NAMES, LATEST_ALERTS
from roadpulse.sinks.database import write_database
from roadpulse.sinks.store import write_alerts, write_summary
from roadpulse.sources.database import Database, database_count
from roadpulse.sources.lake import read_lake
from roadpulse.sources.store import (
    ALERTS,
    LATEST_NAME,
    SUMMARY_NAME,
    Pin,
    read_dated_alerts,
    read_latest,
    read_summary,
    read_table,
    read_tables,
)
from roadpulse.sources.versions import NO_DATE, Draft, Version, find, pinned


class FollowedStore(RuntimeError):
    """The store is kept by following a lake; a run over the lake would mix the two."""


class CountMismatch(RuntimeError):
    """A serving table does not hold the rows of its stored table."""


@dataclass(frozen=True)
class Refresh:
    """Where a run reads and writes."""

    lake: str
    store: str
    lake_format: str = "json"
    database: Database | None = None
    published: tuple[str, ...] = tuple(KPI_NAMES)
    alert_connections: int = 8


def compute_kpis(events: DataFrame) -> dict[str, DataFrame]:
    """The five indicators of a batch of events, nothing written.

    The aggregates share one summary; each result that is used alone still reads
    the events once. ``store_kpis`` writes the summary first and reads them once in all.
    """
    return {
        **summary.indicators(summary.summarize(events)),
        ALERTS: kpis.congestion_alerts(events),
    }


def _of_dates(dates: set[date | None]) -> Column:
    known = F.col("date").isin([day for day in dates if day is not None])
    return known | F.col("date").isNull() if None in dates else known


def store_kpis(
    spark: SparkSession, events: DataFrame, store: str, dates: Iterable[date] | None = None
) -> Version:
    """Computes and stores the five tables as one new version; with ``dates`` only these are read again.

    The named dates are the scope: nothing that was stored of them is in the new version, also where
    nothing takes its place. Until the version is complete readers see the one before, and a run that
    breaks off leaves it as it is. A store that follows a lake is refused.

    Two passes over the events: one for the summary behind the four aggregates, one
    for the alerts. The stored summary cuts the lineage, so that a lost executor or a
    failed table does not send the run back to the lake.
    """
    if "date" not in events.columns:
        events = route(events)
    base = find(spark, store)
    if base is not None and base.stream is not None:
        raise FollowedStore(f"{store} follows a lake: refresh it by following, or use a new store")
    days = None
    if dates is not None:
        dates = set(dates)
        events = events.filter(_of_dates(dates))
        days = {NO_DATE if x is None else x.isoformat() for x in dates}
    draft = Draft(spark, store, base)
    alerts = events.filter(kpis.congested()).select(*ALERT_COLUMNS, "date")
    # Independent jobs are handed in together; the cluster fills the gaps between them.
    with ThreadPoolExecutor(max_workers=4) as jobs:
        written = jobs.submit(write_alerts, draft, alerts)
        draft.replace_dates(SUMMARY_NAME, write_summary(draft, summary.summarize(events)), days)
        stored = read_summary(spark, store, draft.version)
        running = jobs.submit(write_indicators, draft, stored)
        draft.replace_dates(ALERTS, written.result(), days)
        draft.write_small(_newest(spark, store, draft.version), LATEST_NAME)
        running.result()
    return draft.commit()


def write_indicators(draft: Draft, table: DataFrame) -> None:
    """The four aggregate indicators of a summary, written side by side."""
    tables = summary.indicators(table)
    with ThreadPoolExecutor(max_workers=len(tables)) as jobs:
        running = [jobs.submit(draft.write_small, table, name) for name, table in tables.items()]
        for job in running:
            job.result()


def publish(
    spark: SparkSession,
    store: str,
    database: Database,
    tables: Iterable[str] = KPI_NAMES,
    alert_connections: int = 8,
    version: Pin = None,
) -> None:
    """Stored tables of one version into the database; the small ones in one transaction each.

    The alerts are loaded whole, whatever their size. Where they outgrow the database,
    leave them out of ``tables`` and serve them from the store.
    """
    version = pinned(spark, store, version)
    for name in tables:
        connections = alert_connections if name == ALERTS else 1
        write_database(read_table(spark, store, name, version), database, name, connections)


def verify(
    spark: SparkSession,
    store: str,
    database: Database | None = None,
    tables: Iterable[str] = KPI_NAMES,
    version: Pin = None,
) -> dict[str, int]:
    """Row counts of the stored tables of one version; fails on an empty one.

    Alerts may be absent on a quiet day. With a database, its ``tables`` must hold the
    same number of rows.
    """
    counts = row_counts(read_tables(spark, store, version))
    for name in KPI_NAMES:
        if name != ALERTS:
            require_rows(counts[name], name)
    if database is not None:
        for name in tables:
            found = database_count(spark, database, name)
            if found != counts[name]:
                raise CountMismatch(f"{name}: {counts[name]} rows stored, {found} in the database")
    return counts


def run(
    spark: SparkSession, refresh: Refresh, dates: Iterable[date] | None = None
) -> dict[str, int]:
    """Compute, publish, verify. A repeated run leaves the same tables."""
    events = read_lake(spark, refresh.lake, refresh.lake_format)
    return serve(spark, refresh, store_kpis(spark, events, refresh.store, dates))


def serve(spark: SparkSession, refresh: Refresh, version: Pin = None) -> dict[str, int]:
    """Publish what is stored, then verify, both of one version."""
    version = pinned(spark, refresh.store, version)
    store, database, published = refresh.store, refresh.database, refresh.published
    if database is not None:
        publish(spark, store, database, published, refresh.alert_connections, version)
    return verify(spark, store, database, published, version)


def latest_alerts(
    spark: SparkSession, store: str, k: int = LATEST_ALERTS, version: Pin = None
) -> DataFrame:
    """The newest stored alerts: of the few that each version keeps apart, or, where more are asked
    for, read from the newest dates that hold ``k`` of them."""
    version = pinned(spark, store, version)
    if k <= LATEST_ALERTS:
        return panels.latest_alerts(read_latest(spark, store, version), k)
    return _newest(spark, store, version, k)


def _newest(spark: SparkSession, store: str, version: Version, k: int = LATEST_ALERTS) -> DataFrame:
    since = summary.newest_alert_dates(read_summary(spark, store, version), k)
    return panels.latest_alerts(read_dated_alerts(spark, store, version), k, since)
