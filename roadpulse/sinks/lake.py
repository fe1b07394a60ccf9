"""Writing events into the lake."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roadpulse.functions.codec import iso_text
from roadpulse.functions.traffic import wall_time
from roadpulse.operators.ingest import route, spread
from roadpulse.schema import EVENT_COLUMNS, EXTRA, LAKE_PARTITIONS
from roadpulse.sources.lake import require_no_stream_log

PARTITIONS = LAKE_PARTITIONS.fieldNames()


def make_folder(spark: SparkSession, path: str) -> None:
    """The folder, empty where it was missing, so that it can be followed before the first event."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)


def lake_rows(events: DataFrame, fmt: str = "json") -> DataFrame:
    """Rows as the lake stores them: the time as text in JSON, typed in Parquet.

    The message of events that hold more than their columns (EXTRA) is stored with them.
    """
    extra = [EXTRA] if EXTRA in events.columns else []
    routed = route(events).select(*EVENT_COLUMNS, *extra, "date")
    if fmt == "json":
        # Text keeps what the sensor wrote; a typed JSON write would lose digits.
        if dict(events.dtypes)["event_time"] != "string":
            routed = routed.withColumn("event_time", iso_text())
        return routed
    return routed.withColumn("event_time", wall_time())


def write_lake(events: DataFrame, root: str, fmt: str = "json", mode: str = "append") -> None:
    """Backfills the lake with a batch of events."""
    require_no_stream_log(events.sparkSession, root)
    rows = spread(lake_rows(events, fmt))
    rows.write.partitionBy(*PARTITIONS).mode(mode).format(fmt).save(root)
