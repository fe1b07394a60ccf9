"""Streams of raw messages with a ``value`` column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roadpulse.schema import CONSUMER_GROUP, TOPIC


def topic(
    spark: SparkSession,
    servers: str,
    name: str = TOPIC,
    group: str = CONSUMER_GROUP,
    starting_offsets: str = "earliest",
    batch_rows: int | None = None,
    min_partitions: int | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """A topic from its earliest message on; progress is kept in the query's checkpoint.

    ``batch_rows`` bounds a micro-batch. ``min_partitions`` cuts busy topic
    partitions into several tasks, so that one of them cannot hold a batch back.
    The connector must be on the class path (``--packages spark-sql-kafka``).
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", name)
        .option("groupIdPrefix", group)
        .option("startingOffsets", starting_offsets)
    )
    if batch_rows is not None:
        reader = reader.option("maxOffsetsPerTrigger", batch_rows)
    if min_partitions is not None:
        reader = reader.option("minPartitions", min_partitions)
    return reader.options(**(options or {})).load().select("key", "value", "timestamp")


def message_files(
    spark: SparkSession, path: str, files_per_batch: int | None = None
) -> DataFrame:
    """Text files with one message per line, picked up as they arrive."""
    reader = spark.readStream
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(path)
