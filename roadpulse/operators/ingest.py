"""Messages to lake rows: decode, set bad records aside, route by event time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.functions.codec import (
    event_json,
    holds_more,
    iso_text,
    parse_message,
    reject_reason,
    whole_event,
)
from roadpulse.functions.traffic import event_date, wall_time
from roadpulse.schema import EXTRA


def decode(messages: DataFrame, value: str = "value") -> DataFrame:
    """All input columns, plus ``event`` (struct) and ``reason`` (NULL when good).

    The parse sits in a generator on purpose: a filter on ``reason`` cannot be
    pushed below it, so the text is parsed once. As a plain column the optimizer
    copies the parse into the filter, once for each field that is looked at.
    """
    text = messages.withColumn(value, F.col(value).cast("string"))
    parsed = text.select("*", F.inline(F.array(parse_message(F.col(value)))))
    return parsed.withColumn("reason", reject_reason(F.col(value))).drop("complete", "broken")


def accepted(decoded: DataFrame, *keep: str, extra: str | None = None) -> DataFrame:
    """The good events, flat, with the input columns named in ``keep`` in front.

    Counts and speeds become whole numbers, halves rounded up. With ``extra``, the column
    that holds the messages, a last column EXTRA keeps the whole message wherever it has
    fields the event has not or a reading was rounded, so the raw zone loses nothing.
    """
    good = decoded.filter(F.col("reason").isNull())
    whole = [] if extra is None else [F.when(holds_more(F.col(extra)), F.col(extra)).alias(EXTRA)]
    return good.select(*keep, whole_event().alias("event"), *whole).select(
        *keep, "event.*", *([EXTRA] if whole else [])
    )


def rejected(decoded: DataFrame, *keep: str, value: str = "value") -> DataFrame:
    """Every record left out of the lake, whole, with the reason."""
    return decoded.filter(F.col("reason").isNotNull()).select(*keep, value, "reason")


def encode(events: DataFrame, *keep: str) -> DataFrame:
    """Topic messages: the sensor id as key, the event as JSON text as value."""
    return events.withColumn("event_time", iso_text()).select(
        *keep,
        F.col("sensor_id").cast("binary").alias("key"),
        event_json().cast("binary").alias("value"),
    )


def typed(events: DataFrame) -> DataFrame:
    """Events with ``event_time`` as a wall-clock timestamp."""
    return events.withColumn("event_time", wall_time())


def route(events: DataFrame) -> DataFrame:
    """Adds the lake partition ``date``, taken from the event and never from arrival."""
    return events.withColumn("date", event_date())


def spread(routed: DataFrame, tasks_per_file: int = 4, partitions: int | None = None) -> DataFrame:
    """Gathers the rows of a ``(date, zone)`` pair before the lake is written.

    Not into one task: a zone that holds a third of the rows would stall it. In a batch
    the adaptive planner cuts large pairs by size. A stream, or a batch without that
    planner, cuts a pair by the input tasks its rows come from, ``tasks_per_file`` of
    them to a piece. A piece is therefore never larger than that many input splits, and
    a small batch still makes one file per pair. An input task that is run again keeps
    its number, so every row goes to the same piece as before.
    """
    adaptive = routed.sparkSession.conf.get("spark.sql.adaptive.enabled").lower() == "true"
    keys = ["date", "zone"]
    if routed.isStreaming or not adaptive:
        piece = F.floor(F.spark_partition_id() / tasks_per_file)
        routed = routed.withColumn("piece", piece)
        keys.append("piece")
    number = [partitions] if partitions else []
    if adaptive:
        # Large partitions are cut further, small ones put together.
        gathered = routed.hint("rebalance", *number, *keys)
    else:
        gathered = routed.repartition(*number, *keys)
    return gathered.drop("piece")


def partition_counts(lake: DataFrame) -> DataFrame:
    """Events per ``(date, zone)``; reads no data column."""
    return lake.groupBy("date", "zone").agg(F.count("*").alias("events"))


def observe_ingest(decoded: DataFrame, name: str = "ingest") -> DataFrame:
    """Counts kept and rejected records of each batch in passing, without a second read."""
    return decoded.observe(
        name,
        F.count("*").alias("messages"),
        F.count_if(F.col("reason").isNull()).alias("accepted"),
        F.count_if(F.col("reason").isNotNull()).alias("rejected"),
    )
