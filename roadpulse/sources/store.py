"""The stored indicator tables and the summary they come from (Parquet), in versions.

Every function reads the newest version at the moment it is called, or the one it is given (see
``sources.versions``); tables read with one version belong together, whatever is written meanwhile.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from roadpulse.operators.summary import merge
from roadpulse.schema import KPI_NAMES, KPI_SCHEMAS, SUMMARY
from roadpulse.sources.versions import Version, pinned, read_dated, read_small

ALERTS = "congestion_alerts"
SUMMARY_NAME = "event_summary"
#: The newest alerts, as many as the dashboard shows, and the summary of a followed store without dates.
LATEST_NAME, TOTALS_NAME = "latest_alerts", "summary_totals"
_LATEST_COLUMNS = ["zone", "road_type", "average_speed", "event_time"]
LATEST = T.StructType([KPI_SCHEMAS[ALERTS][x] for x in _LATEST_COLUMNS])

Pin = Version | int | None


def read_table(spark: SparkSession, store: str, name: str, version: Pin = None) -> DataFrame:
    """One indicator table with its published columns."""
    version, schema = pinned(spark, store, version), KPI_SCHEMAS[name]
    if name == ALERTS:
        return read_dated_alerts(spark, store, version).select(*schema.fieldNames())
    return read_small(spark, store, version, name, schema)


def read_tables(spark: SparkSession, store: str, version: Pin = None) -> dict[str, DataFrame]:
    version = pinned(spark, store, version)
    return {name: read_table(spark, store, name, version) for name in KPI_NAMES}


def read_dated_alerts(spark: SparkSession, store: str, version: Pin = None) -> DataFrame:
    """The alerts with the partition column ``date``, for reads of a few dates."""
    version = pinned(spark, store, version)
    return read_dated(spark, store, version.dated.get(ALERTS, {}), ALERTS, KPI_SCHEMAS[ALERTS])


def read_batch_alerts(spark: SparkSession, store: str, version: Version) -> DataFrame:
    """The alerts that the version's last batch added to a followed store."""
    found = version.dated.get(ALERTS, {}).items()
    parts = {day: [x for x in labels if x[0] == version.batch_label] for day, labels in found}
    return read_dated(spark, store, parts, ALERTS, KPI_SCHEMAS[ALERTS])


def read_summary(spark: SparkSession, store: str, version: Pin = None) -> DataFrame:
    """The stored summary; what batches added to a date is added up here."""
    parts = pinned(spark, store, version).dated.get(SUMMARY_NAME, {})
    stored = read_dated(spark, store, parts, SUMMARY_NAME, SUMMARY)
    if any(len(found) > 1 for found in parts.values()):
        stored = merge(stored)
    return stored.select(*SUMMARY.fieldNames())


def read_totals(spark: SparkSession, store: str, version: Pin = None) -> DataFrame:
    """The summary of a followed store without dates: a row an hour of day, zone and road type."""
    return read_small(spark, store, pinned(spark, store, version), TOTALS_NAME, SUMMARY)


def read_latest(spark: SparkSession, store: str, version: Pin = None) -> DataFrame:
    """The newest alerts, kept apart: no more rows than the dashboard shows."""
    return read_small(spark, store, pinned(spark, store, version), LATEST_NAME, LATEST)


def register_views(spark: SparkSession, store: str, version: Pin = None) -> None:
    """The five tables of one version as temporary views, so that dashboard SQL runs unchanged."""
    for name, table in read_tables(spark, store, version).items():
        table.createOrReplaceTempView(name)
