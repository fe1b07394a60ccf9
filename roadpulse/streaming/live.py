"""Live alerts and hourly traffic from a stream of events."""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from roadpulse.functions.traffic import wall_time
from roadpulse.operators.checks import ATTRIBUTES, combinations, conflicts
from roadpulse.operators.ingest import route
from roadpulse.operators.kpis import congestion_alerts
from roadpulse.operators.windows import added_hours, hourly_by_zone, hourly_sums, merged_hours
from roadpulse.sources.folder import Folder
from roadpulse.streaming.ingest import _start, start_batches

HOUR_SUMS = "window_start TIMESTAMP_NTZ, zone STRING, vehicles BIGINT, counted BIGINT, events BIGINT"


def start_alerts(
    events: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Congestion alerts as the events come in; no state."""
    alerts = route(congestion_alerts(events))
    writer = alerts.writeStream.format("parquet").partitionBy("date").option("path", path)
    return _start(writer, checkpoint, trigger)


def start_hourly(
    events: DataFrame,
    path: str,
    checkpoint: str,
    delay: str = "10 minutes",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Hourly traffic by zone, each window once, when no late event can change it."""
    hours = hourly_by_zone(events, delay)
    return _start(hours.writeStream.format("parquet").option("path", path), checkpoint, trigger)


def late_rows(query: StreamingQuery) -> int:
    """What ``start_hourly`` left out because its hour was closed: rows after the events of a task
    were combined by hour and zone, in the batches the query remembers. Zero means nothing is missing."""
    states = (state for batch in query.recentProgress for state in batch.stateOperators)
    return sum(state.numRowsDroppedByWatermark for state in states)


class Hours:
    """Hours in three tables that belong together: ``closed`` has each hour once, when late events can
    hardly change it; ``late`` what came after that, and events without a time; ``open`` the rest.

    A batch reads the open hours and the mark, the time up to which hours are closed, that the batch
    before it left, and writes its own. What it reads stays as it is, so a batch that broke off is
    done again with the same result; its files are replaced, and nothing is counted twice.
    """

    def __init__(self, spark: SparkSession, path: str, delay: timedelta):
        self.spark, self.path, self.delay = spark, path, delay
        self.folder = Folder(spark, path)

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.schema(HOUR_SUMS).parquet(f"{self.path}/{name}")

    def _write(self, sums: DataFrame, name: str) -> None:
        sums.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/{name}")

    def mark(self, number: int) -> datetime | None:
        if number < 0:
            return None
        text = self.folder.read(f"_marks/{number}")
        return datetime.fromisoformat(text) if text else None

    def add(self, batch: DataFrame, number: int) -> None:
        before, newest = self.mark(number - 1), Observation()
        seen = batch.observe(newest, F.max(wall_time()).alias("time"))
        self._write(hourly_sums(seen), "_running/part")
        part, latest = self._read("_running/part"), newest.get["time"]
        late = F.col("window_start").isNull() | _is_over(before)
        opened = part.filter(~late)
        if number > 0:
            opened = merged_hours(self._read(f"_running/open-{(number - 1) % 2}").unionByName(opened))
        marks = [x for x in (before, latest and latest - self.delay) if x is not None]
        after = max(marks, default=None)
        self._write(part.filter(late), f"late/batch={number}")
        self._write(opened.filter(~_is_over(after)), f"_running/open-{number % 2}")
        self._write(opened.filter(_is_over(after)), f"closed/batch={number}")
        self.folder.delete(f"_marks/{number}")
        self.folder.write(f"_marks/{number}", after.isoformat() if after else "")
        self.folder.delete(f"_marks/{number - 2}")

    def last(self) -> int:
        return max((int(x) for x in self.folder.names("_marks") if x.isdigit()), default=-1)

    def read(self) -> DataFrame:
        """Sums of all parts up to the last whole batch, with ``part``: closed, late or open."""
        last = self.last()
        if last < 0:
            return self.spark.createDataFrame([], f"{HOUR_SUMS}, part STRING")
        whole = F.col("batch") <= last
        done = [self._read(x).filter(whole).drop("batch").withColumn("part", F.lit(x)) for x in ("closed", "late")]
        return done[0].unionByName(done[1]).unionByName(self._read(f"_running/open-{last % 2}").withColumn("part", F.lit("open")))


def _is_over(mark: datetime | None) -> Column:
    """Whether an hour ends at the mark or before it."""
    if mark is None:
        return F.lit(False)
    end = F.col("window_start") + F.make_dt_interval(F.lit(0), F.lit(1))
    return F.coalesce(end <= F.lit(mark.isoformat(sep=" ")).cast("timestamp_ntz"), F.lit(False))


def start_hours(
    events: DataFrame,
    path: str,
    checkpoint: str,
    delay: timedelta = timedelta(minutes=10),
    trigger: dict | None = None,
) -> StreamingQuery:
    """Hourly traffic by zone: closed hours once each, and what comes too late for them beside them
    (see ``Hours``), so that nothing is left out. There is no state; open hours are a small table."""

    def write(batch: DataFrame, number: int) -> None:
        Hours(batch.sparkSession, path, delay).add(batch, number)

    return start_batches(events, write, checkpoint, trigger)


def read_parts(spark: SparkSession, path: str) -> DataFrame:
    """Sums by hour, zone and part (closed, late, open) of ``start_hours``; ``added_hours`` of all of
    them is the traffic of all events, of the closed ones what was sent, of both what is known now."""
    return Hours(spark, path, timedelta()).read()


def start_sensor_check(
    events: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Keeps what each sensor was seen with, reading new events only; see ``read_conflicts``.

    A batch adds the combinations that are new, as a rule none, so the table grows with sensors and
    conflicts, not with events. A batch done again replaces what it added.
    """

    def write(batch: DataFrame, number: int) -> None:
        found = combinations(batch)
        if number > 0:
            known = _seen(batch.sparkSession, path).filter(F.col("batch") < number).drop("batch")
            same = [F.col(f"n.{x}").eqNullSafe(F.col(f"k.{x}")) for x in known.columns]
            found = found.alias("n").join(known.alias("k"), reduce(and_, same), "left_anti")
        found.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return start_batches(events.select("sensor_id", *ATTRIBUTES), write, checkpoint, trigger)


def _seen(spark: SparkSession, path: str) -> DataFrame:
    kinds = ", ".join(f"{x} STRING" for x in ("sensor_id", *ATTRIBUTES))
    return spark.read.schema(f"{kinds}, batch INT").parquet(path)


def read_conflicts(spark: SparkSession, path: str) -> DataFrame:
    """Sensors seen with more than one road, road type or zone in any of the batches."""
    return conflicts(combinations(_seen(spark, path)))


def start_hourly_table(
    events: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Hourly traffic by zone with the open hours; read it with ``read_hours``.

    No state and no watermark: each batch adds its sums, so an event counts however late it is.
    """

    def write(batch: DataFrame, number: int) -> None:
        _add_hours(batch, path, number)

    return start_batches(events, write, checkpoint, trigger)


def start_live(
    events: DataFrame, alerts: str, hours: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Alerts (``alerts/batch=/date=``) and hourly traffic (see ``read_hours``) in one query.

    A batch is read and decoded once and kept while both are written; there is no state.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            found = route(congestion_alerts(batch))
            found.write.mode("overwrite").partitionBy("date").parquet(f"{alerts}/batch={number}")
            _add_hours(batch, hours, number)
        finally:
            batch.unpersist()

    return start_batches(events, write, checkpoint, trigger)


def _add_hours(events: DataFrame, path: str, number: int) -> None:
    """One file a batch: a row for each zone and hour it has."""
    hourly_sums(events).coalesce(1).write.mode("overwrite").parquet(f"{path}/batch={number}")


def read_hours(spark: SparkSession, path: str) -> DataFrame:
    """Hourly traffic by zone of all batches written so far."""
    return added_hours(spark.read.schema(HOUR_SUMS).parquet(path))
