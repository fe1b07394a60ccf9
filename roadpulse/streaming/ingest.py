"""Messages into the lake, continuously and exactly once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from roadpulse.operators.ingest import (
    accepted,
    decode,
    observe_ingest,
    partition_counts,
    rejected,
    spread,
)
from roadpulse.sinks.lake import PARTITIONS, lake_rows
from roadpulse.sources import commits
from roadpulse.sources.lake import require_no_stream_log, require_stream_lake

# One file per zone and minute by default, instead of one per handful of events.
DEFAULT_TRIGGER = {"processingTime": "1 minute"}
ONCE = {"availableNow": True}
# What is staged is out of sight until its commit, so tasks may put their files in place at once.
STAGED = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}


def _start(writer: DataStreamWriter, checkpoint: str, trigger: dict | None) -> StreamingQuery:
    writer = writer.outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or DEFAULT_TRIGGER)).start()


def start_batches(
    rows: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Hands each batch to ``write``, which must replace what it wrote for the same number before."""
    return _start(rows.writeStream.foreachBatch(write), checkpoint, trigger)


def start_report(
    events: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """What arrived in a lake (``sources.lake.stream_lake``): events by date and zone of each batch.

    Follows the lake's committed files instead of reading the topic again, and of those the
    partition columns only. One file a batch, in ``batch=``; a batch run again replaces it.
    """

    def write(batch: DataFrame, number: int) -> None:
        counts = partition_counts(batch).coalesce(1)
        counts.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return start_batches(events.select("date", "zone"), write, checkpoint, trigger)


class CountsDiffer(RuntimeError):
    """A batch wrote other numbers of messages than it had read."""


def start_ingest(
    messages: DataFrame,
    root: str,
    checkpoint: str,
    fmt: str = "json",
    tasks_per_file: int = 4,
    trigger: dict | None = None,
    partitions: int | None = None,
    rejects: str | None = None,
) -> StreamingQuery:
    """Good messages into the lake, each event under its own date and zone, and with ``rejects`` the
    others there, whole, by reason: both of one read, and each message exactly once.

    A batch is decoded once and kept while both are staged, then committed for both (see
    ``sources.commits``). A batch that broke off before its commit is staged anew, after it moved on.
    No batch is committed whose written rows do not add up to the messages read.

    ``tasks_per_file`` input tasks share a file per date and zone (see ``spread``). Late events need
    no watermark: nothing waits, nothing is dropped. Files that others wrote into the lake stay in
    sight, unless they are read through the log of a file stream: such a lake is refused.
    """
    require_no_stream_log(messages.sparkSession, root)

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        stream = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        roots = (root,) if rejects is None else (root, rejects)
        known = commits.state(spark, root, stream, number)
        if known is None:
            commits.commit(spark, root, _stage(batch, stream, number))
        if known != commits.DONE:
            commits.publish(spark, root, stream, number, *roots)

    def _stage(batch: DataFrame, stream: str, number: int) -> commits.Batch:
        read, good, bad = Observation(), Observation(), Observation()
        failed = F.count_if(F.col("reason").isNotNull()).alias("rejected")
        batch = batch.observe(read, F.count("*").alias("messages"), failed)
        if rejects is not None:  # read once for two outputs
            batch.persist()
        try:
            rows = spread(lake_rows(accepted(batch, extra="value"), fmt), tasks_per_file, partitions)
            rows = rows.observe(good, F.count("*").alias("rows"))
            to = rows.write.options(**STAGED).partitionBy(*PARTITIONS).mode("overwrite").format(fmt)
            to.save(commits.staged(root, stream, number))
            if rejects is not None:
                left = rejected(batch).observe(bad, F.count("*").alias("rows"))
                to = left.write.options(**STAGED).partitionBy("reason").mode("overwrite")
                to.parquet(commits.staged(rejects, stream, number))
        finally:
            batch.unpersist()
        left_out = read.get["rejected"] if rejects is None else bad.get["rows"]
        counted = commits.Batch(stream, number, read.get["messages"], good.get["rows"], left_out)
        require_sum(counted)
        return counted

    decoded = observe_ingest(decode(messages.select("value")))
    return start_batches(decoded, write, checkpoint, trigger)


def require_sum(batch: commits.Batch) -> None:
    if batch.messages != batch.accepted + batch.rejected:
        raise CountsDiffer(
            f"batch {batch.number}: {batch.messages} messages read, {batch.accepted} accepted"
            f" and {batch.rejected} rejected ones written"
        )


def start_conversion(
    events: DataFrame,
    root: str,
    checkpoint: str,
    tasks_per_file: int = 4,
    trigger: dict | None = None,
) -> StreamingQuery:
    """A JSON lake (see ``sources.lake.stream_lake``) into a Parquet lake, each file once.

    Indicators over the typed lake read a fraction of the bytes and parse nothing.
    """
    require_stream_lake(events.sparkSession, root, "parquet")
    rows = spread(lake_rows(events, "parquet"), tasks_per_file)
    writer = rows.writeStream.format("parquet").partitionBy(*PARTITIONS).option("path", root)
    return _start(writer, checkpoint, trigger)


def start_rejects(
    messages: DataFrame, root: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Messages kept out of the lake, whole, by reason, without the lake; ``start_ingest`` writes both."""
    rows = rejected(decode(messages))
    writer = rows.writeStream.format("parquet").partitionBy("reason").option("path", root)
    return _start(writer.queryName("rejects"), checkpoint, trigger)
