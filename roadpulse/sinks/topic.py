"""Publishing events to a topic, keyed by sensor."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from roadpulse.operators.ingest import encode
from roadpulse.schema import TOPIC


def write_topic(events: DataFrame, servers: str, name: str = TOPIC) -> None:
    (
        encode(events)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", name)
        .save()
    )


def start_topic(
    events: DataFrame, servers: str, checkpoint: str, name: str = TOPIC
) -> StreamingQuery:
    return (
        encode(events)
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", name)
        .option("checkpointLocation", checkpoint)
        .start()
    )
