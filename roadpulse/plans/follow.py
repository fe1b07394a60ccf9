"""Indicators that follow the lake: events are read when they arrive and not again.

The summary consists of sums and counts, so that of new events is stored beside the older
ones, by date, and added up when it is read. The four indicators need it without the date: these
totals, a few rows an hour of day, zone and road type, are carried from version to version, and so are
the newest alerts. A batch therefore costs what arrives in it, however many dates there are. Its tables
become one version of the store (``sources.versions``), which says the batch: a batch that broke off is
done again, and one that is in a version is not. Small parts of a date are joined when there are many.
A store is kept either this way or by runs over the lake (``plans.refresh``), never by both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from roadpulse.operators import kpis, panels, summary
from roadpulse.operators.checks import require_rows
from roadpulse.plans.refresh import FollowedStore, Refresh, publish, write_indicators
from roadpulse.schema import ALERT_COLUMNS, KPI_SCHEMAS, SUMMARY
from roadpulse.sinks.database import load_once
from roadpulse.sinks.store import compact, write_alerts, write_summary
from roadpulse.sources.lake import stream_lake
from roadpulse.sources.store import (
    ALERTS,
    LATEST_NAME,
    SUMMARY_NAME,
    TOTALS_NAME,
    read_batch_alerts,
    read_latest,
    read_table,
    read_totals,
)
from roadpulse.sources.versions import Draft, Version, find, read_dated
from roadpulse.streaming.ingest import ONCE

#: Folder of a store in which following keeps its progress.
PROGRESS = "_progress"


def add_batch(
    spark: SparkSession, events: DataFrame, store: str, batch: int, stream: str = ""
) -> Version:
    """Adds a batch of events, with ``date``, to the stored tables, as one version.

    The first batch of a stream starts the store afresh, whatever it held. A batch that the store
    has already is left as it is.
    """
    base = find(spark, store)
    if base is not None and base.stream == stream and batch <= base.batch:
        return base
    if batch > 0 and (base is None or base.stream != stream):
        raise FollowedStore(f"{store} does not hold the batches before {batch} of this stream")
    draft = Draft(spark, store, base, keep_tables=batch > 0)
    part = write_summary(draft, summary.summarize(events))
    added = read_dated(spark, store, part, SUMMARY_NAME, SUMMARY).select(*SUMMARY.fieldNames())
    total = added.withColumn("date", F.lit(None).cast("date"))
    found = write_alerts(draft, events.filter(kpis.congested()).select(*ALERT_COLUMNS, "date"))
    newest = panels.latest_alerts(read_dated(spark, store, found, ALERTS, KPI_SCHEMAS[ALERTS]))
    if batch > 0:
        total = read_totals(spark, store, base).unionByName(total)
        newest = panels.latest_alerts(read_latest(spark, store, base).unionByName(newest))
    draft.add(SUMMARY_NAME, part)
    draft.add(ALERTS, found)
    draft.write_small(summary.merge(total), TOTALS_NAME)
    draft.write_small(newest, LATEST_NAME)
    write_indicators(draft, read_totals(spark, store, draft.version))
    return draft.commit(stream=stream, batch=batch, batch_label=draft.label)


def publish_batch(spark: SparkSession, refresh: Refresh, version: Version) -> None:
    """The four small tables whole, and the alerts of the version's batch where alerts are published.

    The alerts of a batch are loaded once, however often the batch is done (see
    ``sinks.database.load_once``). The first batch replaces what is there.
    """
    small = [name for name in refresh.published if name != ALERTS]
    publish(spark, refresh.store, refresh.database, small, version=version)
    if ALERTS in refresh.published:
        alerts = read_batch_alerts(spark, refresh.store, version).select(*ALERT_COLUMNS)
        key = f"{version.stream}/{version.batch}"
        load_once(alerts, refresh.database, ALERTS, key, refresh.alert_connections, version.batch == 0)


def start_following(
    spark: SparkSession,
    refresh: Refresh,
    trigger: dict | None = None,
    files_per_batch: int | None = None,
    events: DataFrame | None = None,
) -> StreamingQuery:
    """Compute and publish for the events that reach the lake.

    Each batch checks that the indicators have rows; ``plans.refresh.verify`` compares
    all counts, for instance once a run.

    The progress is kept inside the store, as the two belong together. ``events`` takes
    the place of the lake, for instance the union of the streams of two lakes.
    """

    def add(arrived: DataFrame, batch: int) -> None:
        stream = arrived.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        version = add_batch(spark, arrived, refresh.store, batch, stream)
        require_rows(read_table(spark, refresh.store, "traffic_by_zone", version), "traffic_by_zone")
        if refresh.database is not None:
            publish_batch(spark, refresh, version)
        compact(spark, refresh.store)

    if events is None:
        events = stream_lake(
            spark, refresh.lake, refresh.lake_format, files_per_batch=files_per_batch
        )
    # Selected here and not in the batch, whose columns are all read whatever it uses.
    used = events.select("vehicle_count", *ALERT_COLUMNS, "date")
    writer = used.writeStream.foreachBatch(add)
    writer = writer.option("checkpointLocation", f"{refresh.store}/{PROGRESS}")
    return writer.trigger(**(trigger or ONCE)).start()
