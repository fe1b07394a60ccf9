"""Session for streams and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def stream_session(spark: SparkSession, state_partitions: int = 8) -> SparkSession:
    """A session of the same application with settings of its own for windowed streams.

    UTC, so that wall-clock times pass through watermarks and windows unchanged.
    Window state has one group per zone and hour, already combined on the map side,
    so a few state partitions do, whatever the batch size; their number is fixed
    with the first checkpoint.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", "UTC")
    session.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    return session


def scratch(spark: SparkSession, name: str) -> str:
    """A new directory path in the folder that all executors share."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.gettempdir()
    return f"{shared.rstrip('/')}/roadpulse/{name}-{uuid.uuid4().hex}"
